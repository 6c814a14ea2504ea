"""Size-checked broadcast: broadcast a side only after writing and counting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridcast.session import fresh_dir

# Upper bounds on a side we are willing to ship to every executor, in rows and
# in estimated bytes (rows x the schema's default row width). An hourly price
# table holds one row per hour and area: a century of one area is under 900k
# rows of a timestamp and a double (about 14 MB).
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
# Bytes in memory that a byte of a compressed Parquet file is counted as.
UNPACKED = 4
# Rows of a task that are left alone however uneven the tasks of a table are, and
# rows that a spread table's file holds at most, about.
ROWS_PER_TASK = 250_000

_SPREAD: dict[tuple[str, str], str | None] = {}


def row_width(df: DataFrame) -> int:
    """Spark's default size estimate of one row of ``df`` (strings count 20 bytes)."""
    return int(df._jdf.schema().defaultSize())


def written_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under ``path`` (they are compressed)."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return int(root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(root).getLength())


def bounded_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> tuple[DataFrame, int]:
    """Write ``df`` to the shared folder, counting it on the way, and read it back.

    Returns ``(side, rows)``: ``side`` carries a broadcast hint only when
    ``rows <= max_rows`` and neither the schema's width times the rows nor the
    written files, unpacked, exceed ``max_bytes`` (wide strings show in the
    files, not in the schema's width); otherwise it is left to a shuffle join (with AQE's skew split). One job both writes
    and counts (an observed metric of the write). The written table cuts the
    lineage, so the join reads the stored rows instead of computing the side
    again, and a lost executor does not force a recompute.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "checked-side")
    seen = Observation("checked_side")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    rows = int(seen.get["rows"])
    cut = spark.read.schema(df.schema).parquet(path)
    size = max(rows * row_width(cut), UNPACKED * written_bytes(spark, path))
    small = rows <= max_rows and size <= max_bytes
    return (F.broadcast(cut) if small else cut), rows


def unevenly_read(table: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> tuple[bool, int]:
    """(some task reads more than ``rows_per_task`` rows and twice its fair share of
    ``table``, rows): a row group of a Parquet file is read by one task, whatever
    the number of splits. Counts from the files' footers."""
    counts = [r["count"] for r in table.groupBy(F.spark_partition_id().alias("task")).count().collect()]  # a row per task
    rows, cores = sum(counts), table.sparkSession.sparkContext.defaultParallelism
    return max(counts, default=0) > max(rows_per_task, 2 * rows / cores), rows


def spread(table: DataFrame, rows: int, rows_per_task: int = ROWS_PER_TASK) -> str:
    """Folder of the same rows in even files, enough for every core."""
    path = fresh_dir(table.sparkSession, "spread")
    files = max(2 * table.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_task))
    table.repartition(files).write.parquet(path)
    return path


def spread_once(table: DataFrame, name: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``table``, from a copy in even files if a few tasks would read most of it.

    A large table in a few row groups leaves the costly work on its rows (parsing,
    scoring) to as few tasks. A shuffle alone does not help, as filters move below
    it; the copy is an input, written once per session and ``name``.
    """
    spark = table.sparkSession
    key = (spark.sparkContext.applicationId, name)
    if key not in _SPREAD:
        uneven, rows = unevenly_read(table, rows_per_task)
        _SPREAD[key] = spread(table, rows, rows_per_task) if uneven else None
    return table if _SPREAD[key] is None else spark.read.schema(table.schema).parquet(_SPREAD[key])
