"""Silver (refined Parquet): write (S4), scan (S3)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.series import upsample_hold
from gridcast.operators.sizing import bounded_broadcast
from gridcast.session import fresh_dir


def _writer(out: DataFrame, replace: str, keys: Sequence[str]):
    if replace not in ("all", "parts"):
        raise ValueError(f"replace must be 'all' or 'parts', not {replace!r}")
    mode = "static" if replace == "all" else "dynamic"
    return out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*keys, "date")


def write_silver(
    df: DataFrame, path: str, time_col: str = "time_15min", by_date: bool = True, replace: str = "all", keys: Sequence[str] = ()
) -> None:
    """Parquet, the whole table replaced (``replace="all"``), or only the
    partitions written (``"parts"``).

    With ``by_date`` the table is partitioned by ``keys`` (e.g. a site) and the
    reading's date, so later reads filtered on them prune files, and a run with
    ``"parts"`` replaces exactly the (key, date) parts it holds. The
    ``rebalance`` hint clusters rows by part before the write so each task
    writes few files, and lets AQE split a part holding a large share of the
    rows over several tasks (and merge small ones).
    """
    if by_date:
        out = df.withColumn("date", F.to_date(time_col))
        _writer(out.hint("rebalance", *keys, "date"), replace, keys).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_silver_hourly(
    hourly: DataFrame,
    path: str,
    time_col: str = "time",
    out_col: str = "time_15min",
    step_minutes: int = 15,
    replace: str = "all",
    keys: Sequence[str] = (),
) -> DataFrame:
    """C2 + S4 with the shuffle on the hourly rows.

    Clustering by date is the job's only full shuffle. Done on the hourly
    readings it moves a quarter of the rows it would after the upsample; the
    upsample then runs narrow after the exchange, and each writer task holds
    the rows of few dates. The partition value is still the date of each
    15-minute time, so a reading whose quarter-hours cross midnight is filed
    under the right day. Returns the upsampled frame that was written.
    """
    clustered = hourly.withColumn("_day", F.to_date(time_col)).hint("rebalance", *keys, "_day")
    out = upsample_hold(clustered, time_col=time_col, out_col=out_col, step_minutes=step_minutes).drop("_day")
    _writer(out.withColumn("date", F.to_date(out_col)), replace, keys).parquet(path)
    return out


def merge_silver_hourly(hourly: DataFrame, path: str, time_col: str = "time", out_col: str = "time_15min", keys: Sequence[str] = (), landed_col: str = "landed") -> DataFrame:
    """C2 + S4 into parts that already hold rows: a reading is a (key, 15-minute time).

    Of two rows of one reading the one whose file landed last stays; of one
    file's, the larger (temperature, wind speed). Only the (key, date) parts
    that ``hourly`` touches are read, merged and replaced; the merged parts are
    written to the shared folder first, since a job cannot replace what it
    reads. The reduction has a map-side step, so a hot date is combined before
    the shuffle. ``landed`` is a column of the table. Returns the merged parts.
    """
    spark = hourly.sparkSession
    new = upsample_hold(hourly, time_col=time_col, out_col=out_col).withColumn("date", F.to_date(out_col))
    new = staged_table(new, "silver-new")
    parts = [*keys, "date"]
    old = existing_table(spark, path)
    if old is not None:
        touched, _ = bounded_broadcast(new.select(*parts).distinct())
        same = reduce(lambda a, b: a & b, [old[c].cast(new.schema[c].dataType).eqNullSafe(touched[c]) for c in parts])
        new = new.unionByName(old.join(touched, same, "left_semi").select(*[old[c].cast(new.schema[c].dataType).alias(c) for c in new.columns]))
    values = [landed_col, *[c for c in new.columns if c not in (*parts, out_col, landed_col)]]
    merged = new.groupBy(*parts, out_col).agg(F.max(F.struct(*values)).alias("v")).select(*parts, out_col, "v.*")
    merged = staged_table(merged, "silver-merged")
    _writer(merged.hint("rebalance", *parts), "parts", keys).parquet(path)
    return merged


def staged_table(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = fresh_dir(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first write."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(root) and fs.listStatus(root) else None


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    return spark.read.parquet(path)
