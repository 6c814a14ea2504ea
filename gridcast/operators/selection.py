"""Filters (F1-F7), sorts and top-k (T1-T6), and the latest-valid pick."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.functions.timefmt import as_time

# The serving windows around "now", in seconds (all strict).
FRESH_SECONDS = 7200  # |t - now| < 2 h
TODAY_FROM_SECONDS = -12 * 3600  # -12 h < t - now
TODAY_TO_SECONDS = 24 * 3600  # t - now < +24 h
FUTURE_SECONDS = 3600  # t - now > 1 h

Time = str | dt.datetime | Column


FRESH = (-FRESH_SECONDS, FRESH_SECONDS)
TODAY = (TODAY_FROM_SECONDS, TODAY_TO_SECONDS)
FUTURE = (FUTURE_SECONDS, None)


def _shifted(as_of: Time, seconds: int) -> Column:
    return as_of_col(as_of) + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))


def within(t: str | Column, as_of: Time, window: tuple[int | None, int | None], slack: int = 0) -> Column:
    """Strictly between ``as_of`` plus the window's two offsets (seconds; None: open),
    as comparisons of ``t`` with constants, which reach a Parquet scan. ``slack``
    widens both sides."""
    c, (low, high) = F.col(t) if isinstance(t, str) else t, window
    bounds = [c > _shifted(as_of, low - slack)] if low is not None else []
    bounds += [c < _shifted(as_of, high + slack)] if high is not None else []
    return reduce(lambda a, b: a & b, bounds)


def is_fresh(t: str | Column, as_of: Time) -> Column:
    """within two hours of ``as_of``, both ways, strict."""
    return within(t, as_of, FRESH)


def in_today_window(t: str | Column, as_of: Time) -> Column:
    """-12 h < t - as_of < +24 h."""
    return within(t, as_of, TODAY)


def is_future(t: str | Column, as_of: Time) -> Column:
    """more than one hour after ``as_of``."""
    return within(t, as_of, FUTURE)


def as_of_col(as_of: Time) -> Column:
    """"Now" is an argument: a literal time, or a column such as an ingest stamp."""
    return as_of if isinstance(as_of, Column) else as_time(as_of)


def area_filter(df: DataFrame, col: str, areas: str | Sequence[str]) -> DataFrame:
    """one area or a list of areas."""
    values = [areas] if isinstance(areas, str) else list(areas)
    return df.where(F.col(col).isin(values))


def date_range(df: DataFrame, col: str, start: Time, end: Time, end_inclusive: bool = False) -> DataFrame:
    """start <= t < end (or <= end). Pushed to the Parquet scan as a range."""
    c = F.col(col)
    upper = c <= as_of_col(end) if end_inclusive else c < as_of_col(end)
    return df.where((c >= as_of_col(start)) & upper)


def location_filter(df: DataFrame, col: str, value) -> DataFrame:
    """readings of one location."""
    return df.where(F.col(col) == F.lit(value))


def sort_by(df: DataFrame, *cols: str, descending: bool = False) -> DataFrame:
    """A total order (range-partitioned sort, no single-task window)."""
    return df.orderBy(*[F.col(c).desc() if descending else F.col(c).asc() for c in cols])


def newest(df: DataFrame, time_col: str, n: int, tie_col: str | None = None) -> DataFrame:
    """The ``n`` newest rows; ``n == 0`` means no limit.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: every task keeps its
    own top ``n`` and only those are merged.
    """
    order = [F.col(time_col).desc()] + ([F.col(tie_col).desc()] if tie_col else [])
    ordered = df.orderBy(*order)
    return ordered if n == 0 else ordered.limit(n)


def newest_per_key(df: DataFrame, keys: Sequence[str], time_col: str, n: int, tie_col: str | None = None, rank_col: str = "_rank") -> DataFrame:
    """Top-``n`` newest per key with their rank (1 = newest).

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before the
    shuffle, so a key holding a large share of rows ships at most ``n`` rows
    per map task.
    """
    order = [F.col(time_col).desc()] + ([F.col(tie_col).desc()] if tie_col else [])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def latest_valid(
    records: DataFrame,
    time_col: str,
    value_col: str,
    depth: int = 20,
    keys: Sequence[str] = (),
    tie_col: str | None = None,
) -> DataFrame:
    """Among the ``depth`` newest records, the newest whose value is set.

    The limit comes before the filter: when all ``depth`` newest values are
    NULL the answer is empty, even if an older record has a value. With
    ``keys`` (e.g. price area) this is done per key.
    """
    cols = records.columns
    if not keys:
        top = newest(records, time_col, depth, tie_col)
        return newest(top.where(F.col(value_col).isNotNull()), time_col, 1, tie_col).select(*cols)
    ranked = newest_per_key(records, keys, time_col, depth, tie_col)
    valid = ranked.where(F.col(value_col).isNotNull())
    others = [c for c in cols if c not in keys]
    best = valid.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col("_rank")).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in others])


def peek(df: DataFrame, order_col: str | None = None, n: int = 1, area_col: str | None = None, areas: str | Sequence[str] = ()) -> DataFrame:
    """The first ``n`` records (of some areas) as JSON text."""
    d = area_filter(df, area_col, areas) if area_col else df
    d = d.orderBy(order_col) if order_col else d
    return d.limit(n).select(F.to_json(F.struct(*df.columns)).alias("json"))
