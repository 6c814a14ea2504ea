"""Time-bucket join of readings to hourly prices (J1, J2) and price preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.timefmt import PRICE_FORMAT, hour_bucket, parse_time
from gridcast.operators.quality import split_valid
from gridcast.operators.sizing import BROADCAST_MAX_ROWS, bounded_broadcast

# Rows of one key that a list holds at most, and tasks per core that a fan-out is dealt to.
PACK = 256
TASKS_PER_CORE = 4


def price_series(raw: DataFrame, time_col: str = "HourUTC", price_col: str = "SpotPriceEUR", fmt: str = PRICE_FORMAT) -> DataFrame:
    """P9 + X1: raw price records to ``price_time, label`` (plus other columns kept)."""
    return raw.withColumn("price_time", parse_time(time_col, fmt)).withColumnRenamed(price_col, "label")


def hourly_prices(
    prices: DataFrame,
    time_col: str = "price_time",
    price_col: str = "label",
    arrival_cols: str | Sequence[str] = "arrival",
    keys: Sequence[str] = (),
) -> DataFrame:
    """One price per exact price time (and key): the last-arriving priced record wins.

    This is the de-duplication the raw join lacks (overlapping price files
    repeat a time and fan the join out); the time itself is not changed, so an
    off-hour record joins nothing, as in the raw join. Records without a price
    never replace one that has it. ``arrival_cols`` order the records, the
    first column first; each is one aggregate over fixed-width values with a
    partial (map-side) step, so a time holding a large share of the records is
    combined before the shuffle. Output: ``*keys, price_time, label``.
    """
    order = [arrival_cols] if isinstance(arrival_cols, str) else list(arrival_cols)
    rows = prices.where(F.col(time_col).isNotNull() & F.col(price_col).isNotNull() & ~F.isnan(price_col))
    rows = rows.select(*keys, F.col(time_col).alias("price_time"), F.col(price_col).alias("label"), *order)
    while order:
        last = order.pop()
        rows = rows.groupBy(*keys, "price_time", *order).agg(F.max_by("label", last).alias("label"))
    return rows.select(*keys, "price_time", "label")


def split_prices(raw: DataFrame, time_col: str = "price_time", price_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """(records with a time and a price, the rest) for a quarantine."""
    return split_valid(raw, [time_col, price_col])


def packed(rows: DataFrame, by: Sequence[str], size: int = PACK) -> DataFrame:
    """``by, _rows``: the rows of each key in lists of at most ``size`` structs.

    The rows come sorted by key, so the lists are cut by position and a key of
    very many rows is many lists, none longer than ``size``.
    """
    rest = [c for c in rows.columns if c not in by]
    placed = rows.repartition(*by).sortWithinPartitions(*by).withColumn("_pack", F.floor(F.monotonically_increasing_id() / size))
    return placed.groupBy(*by, "_pack").agg(F.collect_list(F.struct(*rest)).alias("_rows")).drop("_pack")


def hour_join(
    readings: DataFrame,
    prices: DataFrame,
    reading_time: str = "time_15min",
    price_time: str = "price_time",
    keys: Sequence[str] = (),
    broadcast_max_rows: int | None = BROADCAST_MAX_ROWS,
    fan_out: bool = False,
) -> DataFrame:
    """Inner join of each reading to the price rows of its truncated hour.

    Semantics are a plain inner equi-join: a reading with no price is dropped,
    an hour present twice in ``prices`` fans out (use ``hourly_prices`` first
    for one price per hour). The price side is counted first and broadcast
    only under ``broadcast_max_rows`` (``None`` leaves the choice to the
    planner); the reading side then streams through a map-side hash join with
    no shuffle. Above the bound both sides shuffle on the hour and AQE splits
    a hot hour.

    ``fan_out`` is for prices that hold an hour many times, where the result is
    far larger than both sides: an hour's prices are ``packed`` in lists, so the
    side is counted in lists and a reading meets a few of them, which are
    unpacked after the join; the readings are dealt evenly to the tasks by all
    their values, not by hour, as the work lies in the unpacking, and a task goes
    through its readings by time: readings of one hour follow each other, so a
    written result repeats the hour's prices at once, which compresses. Same rows.
    """
    side = prices.withColumnRenamed(price_time, "_price_hour")
    rest = [c for c in side.columns if c != "_price_hour" and c not in keys]
    if fan_out:
        tasks = TASKS_PER_CORE * readings.sparkSession.sparkContext.defaultParallelism
        side = packed(side, ["_price_hour", *keys])
        readings = readings.repartition(tasks, *readings.columns).sortWithinPartitions(reading_time, *keys)
        readings = readings.where(F.monotonically_increasing_id() >= 0)  # always true: the optimizer drops an order right below a join
    if broadcast_max_rows is not None:
        side, _ = bounded_broadcast(side, broadcast_max_rows)
    left = readings.withColumn("_join_hour", hour_bucket(reading_time))
    cond = [left["_join_hour"] == side["_price_hour"]] + [left[k] == side[k] for k in keys]
    joined = left.join(side, cond, "inner")
    if fan_out:
        lists = joined.select(*[left[c] for c in readings.columns], F.explode("_rows").alias("_row"))
        return lists.select(*readings.columns, *[F.col("_row")[c].alias(c) for c in rest])
    return joined.drop("_join_hour", "_price_hour", *[side[k] for k in keys])
