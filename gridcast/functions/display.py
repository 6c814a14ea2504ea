"""Display text with the consumer's exact number rounding.

The serving layer formats numbers the way C and Python do: the *binary*
value is rounded half-to-even (6.55 is stored as 6.5499... and prints as
"6.5"; 0.125 prints as "0.12"). Spark's ``format_string`` instead rounds the
shortest decimal text half-up ("6.55" -> "6.6"). ``fixed`` reproduces the
exact rounding with JVM-side arithmetic only (no Python), so it stays inside
whole-stage codegen:

1. ``x * 10^d`` is computed exactly as ``p + e`` (Dekker's two-product: ``p``
   is the rounded product, ``e`` its exact error);
2. ``p + e`` is rounded to an integer ``n``, half-to-even, with ``e``
   deciding the cases where ``p`` sits exactly on a half;
3. ``n / 10^d`` is the double nearest a number with ``d`` decimals, so
   ``format_string`` prints it without further rounding.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLITTER = 134217729.0  # 2^27 + 1, Veltkamp split of a double into two halves
_SPEC = re.compile(r"%\.(\d)f")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _round_scaled(a: Column, digits: int) -> Column:
    """Exact half-even rounding of ``a * 10^digits`` to an integer (``a >= 0``)."""
    s = float(10**digits)
    c = F.lit(_SPLITTER) * a
    a_hi = c - (c - a)
    a_lo = a - a_hi
    p = a * F.lit(s)
    e = (a_hi * F.lit(s) - p) + a_lo * F.lit(s)  # exact: p + e == a * s
    f = F.floor(p).cast("double")
    r = p - f
    half_up = F.when(r > 0.5, True).when(r < 0.5, False)
    tie = F.when(e > 0, True).when(e < 0, False).otherwise(F.pmod(f, F.lit(2.0)) == 1.0)
    up = F.when(r == 0.5, tie).otherwise(half_up)
    # r == 0 with e < 0: the exact value is just under f, still nearest to f.
    return F.when(up, f + 1.0).otherwise(f)


def fixed(c: str | Column, digits: int) -> Column:
    """``"%.{digits}f" % x`` with Python/C rounding; NULL stays NULL."""
    x = _col(c).cast("double")
    # From 2**53 on a double is a whole number: printed as such, no scaling.
    small = F.abs(x) < float(2**53 // 10**digits)
    n = F.when(small, _round_scaled(F.abs(x), digits) / F.lit(float(10**digits))).otherwise(F.abs(x))
    body = F.when(F.abs(x) < float(2**53), F.format_string(f"%.{digits}f", n)).otherwise(
        F.concat(F.abs(x).cast("decimal(38,0)").cast("string"), F.lit("." + "0" * digits if digits else ""))
    )
    sign = F.when(x.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))  # also of -0.0
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(x == float("inf"), F.lit("inf"))
        .when(x == float("-inf"), F.lit("-inf"))
        .otherwise(F.concat(sign, body))
    )


def py_format(pattern: str, c: str | Column) -> Column:
    """``pattern % x`` for a pattern with one ``%.Nf`` field (e.g. ``"€ %.2f"``)."""
    m = _SPEC.search(pattern)
    if not m or len(_SPEC.findall(pattern)) != 1:
        raise ValueError(f"unsupported pattern {pattern!r}")
    text = fixed(c, int(m.group(1)))
    prefix, suffix = pattern[: m.start()].replace("%%", "%"), pattern[m.end() :].replace("%%", "%")
    return F.when(_col(c).isNotNull(), F.concat(F.lit(prefix), text, F.lit(suffix)))
