"""Time-series reshaping: flatten nested documents (C1) and hold-upsample."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.timefmt import HOURLY_FORMAT, parse_time, plus_minutes


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def hourly_arrays() -> Column:
    """P2 on a document's ``hourly`` struct: (time_str, temperature, wind_speed) by position."""
    h = F.col("hourly")
    return F.arrays_zip(
        F.coalesce(h["time"], _empty("string")).alias("time_str"),
        F.coalesce(h["temperature_2m"], _empty("double")).alias("temperature"),
        F.coalesce(h["wind_speed_10m"], h["windspeed_10m"], _empty("double")).alias("wind_speed"),
    )


def flatten_series(docs: DataFrame, keep: Sequence[str] = (), time_format: str = HOURLY_FORMAT) -> DataFrame:
    """One row per position of the parallel ``hourly`` arrays.

    Output: ``time_str, temperature, wind_speed, time`` (+ ``keep`` columns).
    The wind array is taken under either of its two names; a missing reading
    array yields NULL readings instead of dropping the document, and arrays of
    different length are padded with NULL up to the longest. A document with
    no ``hourly`` struct yields no rows. ``time`` is NULL when ``time_str``
    does not parse - route such rows with ``split_valid``.
    """
    rows = docs.select(*keep, F.explode(hourly_arrays()).alias("_r"))
    return rows.select(
        *keep,
        F.col("_r.time_str").alias("time_str"),
        F.col("_r.temperature").alias("temperature"),
        F.col("_r.wind_speed").alias("wind_speed"),
        parse_time(F.col("_r.time_str"), time_format).alias("time"),
    )


def hold_offsets(step_minutes: int = 15, period_minutes: int = 60) -> list[int]:
    if step_minutes <= 0 or period_minutes % step_minutes:
        raise ValueError("step_minutes must divide period_minutes")
    return list(range(0, period_minutes, step_minutes))


def upsample_hold(
    df: DataFrame,
    time_col: str = "time",
    out_col: str = "time_15min",
    step_minutes: int = 15,
    period_minutes: int = 60,
) -> DataFrame:
    """Repeat every reading at each step inside its period.

    Replication, not interpolation: an hourly reading becomes four rows at
    +0, +15, +30 and +45 minutes with the same values. Narrow (no shuffle).
    """
    offsets = F.array(*[F.lit(o) for o in hold_offsets(step_minutes, period_minutes)])
    cols: list[str | Column] = [c for c in df.columns if c != time_col]
    return df.select(*cols, F.col(time_col).alias("_base"), F.explode(offsets).alias("_offset")).select(
        *cols, plus_minutes("_base", "_offset").alias(out_col)
    )


def upsample_hold_sql(
    df: DataFrame,
    time_col: str = "time",
    out_col: str = "time_15min",
    step_minutes: int = 15,
    period_minutes: int = 60,
) -> DataFrame:
    """C2 written as Spark SQL over a temporary view (S10, P6), for callers who keep
    their transforms as SQL text.

    A reading holds at every step of its period: the steps are a sequence of
    timestamps from the reading's time, exploded (a narrow Generate). Readings
    need a time; ``split_valid`` sets the others aside before. The view gets a
    fresh name per call, so concurrent jobs in one session do not overwrite
    each other's view, and is dropped once the query is analysed.
    """
    last = hold_offsets(step_minutes, period_minutes)[-1]
    view = f"readings_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    held = f"sequence(`{time_col}`, `{time_col}` + INTERVAL '{last}' MINUTE, INTERVAL '{step_minutes}' MINUTE)"
    columns = [f"`{c}`" for c in df.columns if c != time_col] + [f"explode({held}) AS `{out_col}`"]
    out = df.sparkSession.sql(f"SELECT {', '.join(columns)} FROM {view}")
    # The result is already analysed against the view's plan: drop the name so
    # a long-running session does not collect one view per call.
    df.sparkSession.catalog.dropTempView(view)
    return out
