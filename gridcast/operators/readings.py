"""Reading messages from weather documents, and fetch stamps (P4, P11-P14, C6 output).

What the producers do one record at a time in a loop is a projection here:
a forecast document's parallel arrays become one message per hour (P4), a
live document's ``current`` struct becomes one message stamped with the time
it was taken (P13, P14), and a market record gets its fetch stamp (P12).
All narrow, so a folder of many documents is processed in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.messages import decode
from gridcast.functions.timefmt import PRICE_FORMAT, epoch_seconds, iso_text
from gridcast.operators.selection import latest_valid
from gridcast.operators.series import flatten_series
from gridcast.schemas import MARKET_RECORD

# The source tags the two weather producers put on a message.
FORECAST_SOURCE = "7-day-forecast"
LIVE_SOURCE = "open-meteo-live"

READING_COLUMNS = ["time", "temperature", "wind_speed", "source"]


def forecast_readings(docs: DataFrame, keep: Sequence[str] = (), source: str = FORECAST_SOURCE) -> DataFrame:
    """P4 + P11: a forecast document (``hourly`` parallel arrays) to one reading per hour.

    ``time`` stays the document's text (minute precision). The wind array is
    read under either name, like the flattener; positions missing from a
    shorter array give NULL readings, which the scorer quarantines.
    """
    rows = flatten_series(docs, keep=keep)
    return rows.select(
        *keep,
        F.col("time_str").alias("time"),
        "temperature",
        "wind_speed",
        F.lit(source).alias("source"),
    )


def live_readings(
    docs: DataFrame,
    stamp: str | Column | None = None,
    keep: Sequence[str] = (),
    source: str = LIVE_SOURCE,
) -> DataFrame:
    """P13 + P14 + P11: a live document's ``current`` struct to one reading.

    The reading's own time is replaced by ``stamp`` (the time it was taken),
    as second-precision ISO text. ``stamp`` defaults to the processing time
    (``current_timestamp()``, one value per query or micro-batch); pass a
    column to use a recorded fetch time instead.
    """
    when = F.current_timestamp() if stamp is None else (F.col(stamp) if isinstance(stamp, str) else stamp)
    cur = F.col("current")
    return docs.select(
        *keep,
        iso_text(when, PRICE_FORMAT).alias("time"),
        cur["temperature_2m"].alias("temperature"),
        cur["wind_speed_10m"].alias("wind_speed"),
        F.lit(source).alias("source"),
    )


def with_fetch_stamp(df: DataFrame, at: str | Column | None = None, col: str = "fetched_at") -> DataFrame:
    """Epoch seconds (double) of the fetch; processing time unless ``at`` is given."""
    when = F.current_timestamp() if at is None else (F.col(at) if isinstance(at, str) else at)
    return df.withColumn(col, epoch_seconds(when))


def parse_market_records(text: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Market records held as JSON text: the fields the operators look at, and
    the whole record as it came (``record``), so its other fields ride along."""
    parsed = text.select(*keep, decode(col, MARKET_RECORD).alias("m"), F.col(col).cast("string").alias("record"))
    return parsed.select(*keep, "m.*", "record")


def market_payload() -> Column:
    """P12 on the text: the record with ``fetched_at`` added as its last field."""
    head = F.rtrim(F.col("record"))
    return F.concat(F.left(head, F.length(head) - 1), F.lit(',"fetched_at":'), F.col("fetched_at").cast("decimal(20,6)").cast("string"), F.lit("}"))


def market_messages(
    records: DataFrame,
    time_col: str = "TimeUTC",
    value_col: str = "ImbalancePriceEUR",
    keys: Sequence[str] = ("PriceArea",),
    depth: int = 20,
    tie_col: str | None = None,
    at: str | Column | None = None,
) -> DataFrame:
    """C6 + P12: per area, the newest priced record among its ``depth`` newest,
    stamped with ``fetched_at``. An area whose ``depth`` newest are all
    unpriced sends nothing (F9)."""
    best = latest_valid(records, time_col, value_col, depth=depth, keys=keys, tie_col=tie_col)
    return with_fetch_stamp(best, at)
