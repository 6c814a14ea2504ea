"""Large tables in few row groups are dealt evenly to the tasks."""

import datetime as dt

from pyspark.sql import functions as F

from gridcast.operators.sizing import spread_once, unevenly_read

T = dt.datetime


def test_one_row_group_is_spread_over_the_tasks(spark, tmp_dir):
    spark.range(4000).withColumn("v", F.when(F.col("id") % 3 != 0, F.col("id"))).coalesce(1).write.parquet(f"{tmp_dir}/t")
    table = spark.read.parquet(f"{tmp_dir}/t")
    assert unevenly_read(table, 500) == (True, 4000)
    even = spread_once(table, f"{tmp_dir}/t", 500)
    assert unevenly_read(even, 500) == (False, 4000)
    assert even.schema == table.schema and sorted(even.collect(), key=lambda r: r.id) == sorted(table.collect(), key=lambda r: r.id)


def test_small_and_even_tables_are_read_as_they_are(spark, tmp_dir):
    spark.range(400).coalesce(1).write.parquet(f"{tmp_dir}/t")
    table = spark.read.parquet(f"{tmp_dir}/t")
    assert spread_once(table, f"{tmp_dir}/t") is table
    assert unevenly_read(table.limit(0)) == (False, 0)


def test_a_registered_query_reads_a_large_row_group_in_many_tasks(spark, tmp_dir):
    from gridcast.plans.catalog import _events

    rows = spark.range(600_000).select(
        F.col("id").alias("event_id"), F.lit(T(2024, 1, 1)).cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    assert _events(spark, tmp_dir).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 300_000
    assert _events(spark, tmp_dir).select("event_id").distinct().count() == 600_000
