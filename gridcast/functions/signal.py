"""Trading signal and display formats (X13, X14, P15); the formatting itself is ``functions.display``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Signal thresholds and labels (both bounds are strict, so 30
# and 80 are HOLD).
BUY_BELOW = 30.0
SELL_ABOVE = 80.0
BUY, SELL, HOLD = "BUY", "SELL", "HOLD"

# Display formats.
PRICE_TEXT = "€ %.2f"
WIND_TEXT = "%.1f m/s"
TEMP_TEXT = "%.1f °C"
TABLE_TEXT = "%.2f"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_zero(c: str | Column) -> Column:
    """A missing reading counts as 0 (the consumer's default)."""
    return F.coalesce(_col(c), F.lit(0.0))


def trade_signal(price: str | Column, missing_as_zero: bool = True) -> Column:
    """BUY below 30, SELL above 80, HOLD otherwise.

    With ``missing_as_zero`` a NULL price is BUY (the consumer's behaviour);
    without it a NULL price gives a NULL signal.
    """
    p = or_zero(price) if missing_as_zero else _col(price)
    return (
        F.when(p < BUY_BELOW, F.lit(BUY))
        .when(p > SELL_ABOVE, F.lit(SELL))
        .when(p.isNotNull(), F.lit(HOLD))
    )
