"""The place of every row in a global order, as a column.

A sort alone leaves the order in the files of its result; the position makes it
data that can be joined, paged and compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.sizing import bounded_broadcast
from gridcast.session import fresh_dir


def with_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """``df`` with ``name``: 1, 2, 3, ... in ascending order of ``order`` (NULL first).

    Rows are range-partitioned and sorted inside partitions; a row's place is
    its place in its partition plus the rows of the partitions before, so no
    task sees more than its range. The sorted rows are written once to the
    shared folder: partition numbers stay what they were when counted. Rows
    equal in ``order`` have any order among themselves; give a tie-breaking
    column where that matters, also to let a frequent value be split.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "ordered")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: a bound that does not follow the rows.
    counts = rows.groupBy("_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    offsets, _ = bounded_broadcast(counts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return rows.join(offsets, "_part").withColumn(name, F.col("_at") - F.col("_first") + F.col("_before") + 1).select(*df.columns, name)
