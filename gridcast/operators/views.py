"""Serving views over scored messages (C7, C8, C9; W1, W2, A1-A5, P16, P17).

Input: one row per prediction message with ``time`` (text), ``temperature``,
``wind_speed``, ``price_rf``, ``price_gbt`` and an arrival column (Kafka
offset, ingest sequence, ...). "Now" is the ``as_of`` argument: a literal for
a static table, or a column (an ingest stamp) for rows judged on arrival.
Arrival order decides every "first", "last" and "latest" below, so the views
are deterministic however the rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.display import py_format
from gridcast.functions.signal import PRICE_TEXT, TABLE_TEXT, TEMP_TEXT, WIND_TEXT, or_zero, trade_signal
from gridcast.functions.timefmt import AXIS_DAY_FORMAT, AXIS_HOUR_FORMAT, iso_text, parse_time
from gridcast.operators.selection import FRESH, FUTURE, TODAY, Time, within

# Model labels of the comparison views, and the buffer sizes.
RF_LABEL = "Random Forest (Champion)"
GBT_LABEL = "Gradient Boost (Challenger)"
LIVE_TYPE = "Live"
LIVE_CAP = 100
FORECAST_MAX_ROWS = 800
FORECAST_KEEP_ROWS = 600


def message_rows(pred: DataFrame, arrival_col: str, as_of: Time | None = None, window: tuple[int | None, int | None] | None = None, event_time_col: str | None = None) -> DataFrame:
    """Parse the message time and apply the missing-value default (P15), keeping
    the rows strictly within ``window`` of ``as_of`` if one is given.

    Rows whose time does not parse are dropped here (the consumer skips such
    messages); ``split_valid`` on ``Time`` keeps them for a quarantine sink.
    With ``event_time_col``, a stored TIMESTAMP that the message's time is cut
    to the second from, the window also bounds that column: the scan then
    reads only the row groups of the window instead of all history.
    """
    if window and event_time_col:
        pred = pred.where(within(event_time_col, as_of, window, slack=1))
    rows = pred.select(
        parse_time("time").alias("Time"),
        or_zero("price_rf").alias("price_rf"),
        or_zero("price_gbt").alias("price_gbt"),
        or_zero("wind_speed").alias("wind_speed"),
        or_zero("temperature").alias("temperature"),
        F.col(arrival_col).alias("_arrival"),
    )
    return rows.where(within("Time", as_of, window) if window else F.col("Time").isNotNull())


def current_conditions(pred: DataFrame, as_of: Time, arrival_col: str = "arrival", event_time_col: str | None = None) -> DataFrame:
    """The last-arriving fresh message (|t - now| < 2 h) with its signal.

    One row, or none when nothing is fresh. A global aggregate with a partial
    step: every task keeps only its latest fresh row.
    """
    rows = fresh_rows(pred, as_of, arrival_col, event_time_col)
    last = rows.agg(
        F.max_by(F.struct("Time", "price_rf", "wind_speed", "temperature"), F.col("_arrival")).alias("m")
    ).where(F.col("m").isNotNull())
    return conditions_tile(last.select("m.*"))


def fresh_rows(pred: DataFrame, as_of: Time, arrival_col: str = "arrival", event_time_col: str | None = None) -> DataFrame:
    """F5 on the parsed messages: the candidates for the tiles."""
    return message_rows(pred, arrival_col, as_of, FRESH, event_time_col)


def conditions_tile(last: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """C7's display from the chosen message (``Time, price_rf, wind_speed, temperature``)."""
    tile = last.select(
        *keep,
        "Time",
        F.col("price_rf").alias("price"),
        "wind_speed",
        "temperature",
    )
    return tile.select(
        "*",
        trade_signal("price").alias("signal"),
        py_format(PRICE_TEXT, "price").alias("price_text"),
        py_format(WIND_TEXT, "wind_speed").alias("wind_text"),
        py_format(TEMP_TEXT, "temperature").alias("temp_text"),
    )


def live_series(pred: DataFrame, as_of: Time, arrival_col: str = "arrival", cap: int = LIVE_CAP, event_time_col: str | None = None) -> DataFrame:
    """The "today" series.

    Messages with -12 h < t - now < +24 h (F6) become ``Time, Price, Wind,
    Type`` rows (P16); only the last ``cap`` by arrival are kept (W1, a
    TakeOrderedAndProject), then the first arrival per ``Time`` (A1).
    """
    last = today_rows(pred, as_of, arrival_col, event_time_col).orderBy(F.col("_arrival").desc()).limit(cap)
    return live_view(last)


def today_rows(pred: DataFrame, as_of: Time, arrival_col: str = "arrival", event_time_col: str | None = None) -> DataFrame:
    """F6 on the parsed messages: the rows the live buffer appends."""
    return message_rows(pred, arrival_col, as_of, TODAY, event_time_col)


def future_rows(pred: DataFrame, as_of: Time, arrival_col: str = "arrival", event_time_col: str | None = None) -> DataFrame:
    """F7 on the parsed messages: the rows of the forecast buffer."""
    return message_rows(pred, arrival_col, as_of, FUTURE, event_time_col)


def live_view(last: DataFrame) -> DataFrame:
    """C8's chart rows from the buffered rows: the first arrival per ``Time`` (A1)."""
    first = last.groupBy("Time").agg(
        F.min_by(F.struct(F.col("price_rf").alias("Price"), F.col("wind_speed").alias("Wind")), F.col("_arrival")).alias("r")
    )
    return first.select(
        "Time",
        F.col("r.Price").alias("Price"),
        F.col("r.Wind").alias("Wind"),
        F.lit(LIVE_TYPE).alias("Type"),
        iso_text("Time", AXIS_HOUR_FORMAT).alias("Label"),
    )


def model_long(rows: DataFrame) -> DataFrame:
    """Two model columns to two labelled rows per message (unpivot)."""
    wide = rows.select("Time", "_arrival", F.col("price_rf").alias(RF_LABEL), F.col("price_gbt").alias(GBT_LABEL))
    long = wide.unpivot(["Time", "_arrival"], [RF_LABEL, GBT_LABEL], "Model", "Price")
    # Appends happen RF first, then GBT: keep that order for "last k rows".
    return long.withColumn("_slot", F.when(F.col("Model") == RF_LABEL, 0).otherwise(1))


def forecast_buffer_rows(appended: int, max_rows: int = FORECAST_MAX_ROWS, keep_rows: int = FORECAST_KEEP_ROWS) -> int:
    """Buffer length after ``appended`` rows, two per message.

    The buffer grows by two rows per message and, whenever it passes
    ``max_rows``, is cut back to its last ``keep_rows``.
    """
    if appended <= max_rows:
        return appended
    period = max_rows + 2 - keep_rows
    return keep_rows + (appended - (max_rows + 2)) % period


def forecast_buffer(pred: DataFrame, as_of: Time, arrival_col: str = "arrival", event_time_col: str | None = None) -> DataFrame:
    """W2 over the future messages (F7): the rows the buffer holds now.

    The buffer length k follows from the number of rows ever appended (closed
    form, at most ``FORECAST_MAX_ROWS``): a count of the window's messages, two
    rows each. A re-run task cannot change it. The buffer is the newest k rows
    by arrival, a top-k of which each task keeps only its own. Output: ``Time,
    Model, Price, _arrival, _slot``.
    """
    rows = future_rows(pred, as_of, arrival_col, event_time_col)
    order = [F.col("_arrival").desc(), F.col("_slot").desc()]
    return model_long(rows).orderBy(*order).limit(forecast_buffer_rows(2 * rows.count()))


def model_pivot(long: DataFrame) -> DataFrame:
    """A3 + T6: one row per ``Time`` with a column per model, sorted by time.

    Two different prices for one (Time, Model) resolve to the latest arrival.
    """
    wide = long.groupBy("Time").pivot("Model", [RF_LABEL, GBT_LABEL]).agg(F.max_by("Price", "_arrival"))
    return wide.withColumn("Label", iso_text("Time", AXIS_DAY_FORMAT)).orderBy("Time")


def comparison_table(wide: DataFrame) -> DataFrame:
    """X14 on C9: the raw-data table as shown, every price as ``%.2f`` text
    (exact binary rounding, like the consumer's formatter; NULL stays NULL)."""
    return wide.select(
        "Time",
        *[py_format(TABLE_TEXT, F.col(f"`{label}`")).alias(label) for label in (RF_LABEL, GBT_LABEL)],
    )


def model_comparison(pred: DataFrame, as_of: Time, arrival_col: str = "arrival", event_time_col: str | None = None) -> DataFrame:
    """Champion vs challenger over the forecast buffer."""
    buf = forecast_buffer(pred, as_of, arrival_col, event_time_col)
    return model_pivot(buf)
