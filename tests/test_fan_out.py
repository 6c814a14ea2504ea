"""Prices that hold an hour many times are joined by lists; buckets follow the rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridcast.operators.joins import PACK, hour_join, packed
from gridcast.sources.bucketed import ROWS_PER_BUCKET, hour_buckets

T = dt.datetime


def test_packed_lists_hold_every_row_once_and_are_bounded(spark):
    prices = spark.createDataFrame([(i % 3 if i % 50 else None, float(i)) for i in range(3000)], "h int, label double").repartition(7)
    lists = packed(prices, ["h"]).collect()
    assert max(len(r["_rows"]) for r in lists) <= PACK
    assert sorted((r.h is None, r.h or 0, x.label) for r in lists for x in r["_rows"]) == sorted((r.h is None, r.h or 0, r.label) for r in prices.collect())


@pytest.mark.parametrize("bound", [1_000_000, 0, None])
def test_fan_out_by_lists_equals_the_plain_join(spark, bound):
    prices = spark.createDataFrame(
        [(T(2024, 1, 1, i % 5, 30 * (i % 7 == 0)) if i % 11 else None, float(i % 40), "AB"[i % 2] if i % 13 else None) for i in range(2000)],
        "price_time timestamp, label double, area string",
    )
    readings = spark.createDataFrame(
        [(float(i % 9) if i % 4 else None, T(2024, 1, 1, i % 6, 15 * (i % 4)) if i % 10 else None, "AB"[i % 2] if i % 6 else None) for i in range(60)],
        "temperature double, time_15min timestamp, area string",
    )
    for keys, right in (((), prices.drop("area")), (("area",), prices)):
        plain = hour_join(readings, right, keys=keys)
        lists = hour_join(readings, right, keys=keys, fan_out=True, broadcast_max_rows=bound)
        assert lists.columns == plain.columns and lists.dtypes == plain.dtypes
        assert sorted(map(str, lists.collect())) == sorted(map(str, plain.collect()))
    assert hour_join(readings, prices.limit(0), keys=("area",), fan_out=True).count() == 0


def test_fan_out_counts_lists_and_deals_readings_evenly(spark):
    prices = spark.createDataFrame([(T(2024, 1, 1, 3), float(i)) for i in range(1000)], "price_time timestamp, label double")
    readings = spark.createDataFrame([(float(i), T(2024, 1, 1, 3)) for i in range(4000)], "temperature double, time_15min timestamp").coalesce(1)
    joined = hour_join(readings, prices, fan_out=True, broadcast_max_rows=10)  # 1000 prices are 4 lists
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 4_000_000 and max(tasks) < 1_000_000


def test_buckets_follow_the_rows(spark):
    assert hour_buckets(0, 8) == hour_buckets(320_000, 8) == 8
    assert hour_buckets(100 * ROWS_PER_BUCKET, 8) == 100


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_fan_out_goes_through_the_readings_of_a_task_by_time(spark, bound):
    prices = spark.createDataFrame([(T(2024, 1, 1, i % 24), float(i)) for i in range(480)], "price_time timestamp, label double")
    readings = spark.createDataFrame([(float(i % 97), T(2024, 1, 1, i * 7 % 24, 15 * (i % 4))) for i in range(2000)], "temperature double, time_15min timestamp")
    joined = hour_join(readings, prices, fan_out=True, broadcast_max_rows=bound).withColumn("task", F.spark_partition_id())
    hours = {}
    for r in joined.collect():
        hours.setdefault(r.task, []).append(r.time_15min.hour)
    assert sum(map(len, hours.values())) == 2000 * 20
    assert all(sum(a != b for a, b in zip(h, h[1:])) == len(set(h)) - 1 for h in hours.values())
