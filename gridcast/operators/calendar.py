"""Backfill month chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.timefmt import DAY_FORMAT, MONTH_TAG_FORMAT, month_starts


def month_chunks(bounds: DataFrame, start_col: str = "start", end_col: str = "end", keys: Sequence[str] = ()) -> DataFrame:
    """Split each [start, end] range (dates, inclusive) into calendar months.

    The first chunk starts on ``start``, every other on the 1st; each ends on
    the last day of its month, the final one on ``end`` (F10). ``tag`` is
    ``yyyy_MM`` of the chunk start; ``start_text``/``end_text`` are the
    request bounds (X16). One input row per range, so ranges of many sites or
    areas split in parallel.
    """
    start = F.col(start_col).cast("date")
    end = F.col(end_col).cast("date")
    months = bounds.select(*keys, start.alias("_start"), end.alias("_end"), F.explode(month_starts(start, end)).alias("_month"))
    chunks = months.select(
        *keys,
        F.greatest("_month", "_start").alias("chunk_start"),
        F.least(F.last_day("_month"), F.col("_end")).alias("chunk_end"),
    )
    return chunks.select(
        "*",
        F.date_format("chunk_start", MONTH_TAG_FORMAT).alias("tag"),
        F.date_format("chunk_start", DAY_FORMAT).alias("start_text"),
        F.date_format("chunk_end", DAY_FORMAT).alias("end_text"),
    )
