"""Route rows that cannot be processed to a quarantine instead of failing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, cols: Sequence[str]) -> Column:
    """Every column set, and every double or float of them a finite number (the
    JSON reader lets NaN and infinities through; the learners raise on them).
    Never NULL."""
    kinds = dict(df.dtypes)

    def one(c: str) -> Column:
        x = F.col(c)
        if kinds[c] not in ("double", "float"):
            return x.isNotNull()
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))

    return reduce(lambda a, b: a & b, [one(c) for c in cols])


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every ``required`` column ``usable``, the rest).

    Both halves come from the same plan; persist ``df`` first when both are
    written, so the input is read once.
    """
    ok = usable(df, required)
    return df.where(ok), df.where(~ok)
