"""A key holding a third of the rows: results stay whole and exact, and the
plan splits or pre-combines the hot key instead of sending it whole to one task."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from gridcast.operators.joins import hour_join, hourly_prices
from gridcast.operators.selection import latest_valid

T = dt.datetime


def test_hot_area_latest_valid_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        area = "HOT" if i % 3 == 0 else f"A{rnd.randrange(40)}"
        price = None if rnd.random() < 0.6 else round(rnd.uniform(0, 100), 2)
        rows.append((area, f"2024-01-{1 + rnd.randrange(28):02d}T{rnd.randrange(24):02d}:00:00", price, i))
    df = spark.createDataFrame(rows, "PriceArea string, TimeUTC string, ImbalancePriceEUR double, arrival long").repartition(8)
    got = {r.PriceArea: (r.TimeUTC, r.ImbalancePriceEUR, r.arrival) for r in latest_valid(df, "TimeUTC", "ImbalancePriceEUR", depth=20, keys=["PriceArea"], tie_col="arrival").collect()}

    want = {}
    for area in {r[0] for r in rows}:
        newest = sorted((r for r in rows if r[0] == area), key=lambda r: (r[1], r[3]), reverse=True)[:20]
        priced = [r for r in newest if r[2] is not None]
        if priced:
            want[area] = (priced[0][1], priced[0][2], priced[0][3])
    assert got == want


def test_hot_hour_is_split_by_the_skew_join(spark):
    rnd = random.Random(5)
    hot = T(2024, 1, 1, 12)
    readings = [((hot if i % 3 == 0 else T(2024, 1, 1 + rnd.randrange(20), rnd.randrange(24))) + dt.timedelta(minutes=15 * rnd.randrange(4)), float(i), 1.0) for i in range(30000)]
    w = spark.createDataFrame(readings, "time_15min timestamp, temperature double, wind_speed double").repartition(8)
    p = spark.createDataFrame([(T(2024, 1, 1 + d, h), float(d * 24 + h)) for d in range(20) for h in range(24)], "price_time timestamp, label double")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = hour_join(w, p, broadcast_max_rows=0)
        got = joined.groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s")).first()
        # every reading has a price for its hour: the join keeps them all
        want_s = sum(float((r[0] - T(2024, 1, 1)).days * 24 + r[0].hour) for r in readings)
        assert got.n == len(readings) and abs(got.s - want_s) < 1e-6
        joined.collect()
        final = re.sub(r"#\d+L?", "", joined._jdf.queryExecution().executedPlan().toString())
        assert "isFinalPlan=true" in final and "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_hour_prices_combined_map_side(spark):
    rows = [("2024-01-01T10:00:00" if i % 3 == 0 else f"2024-01-0{1 + i % 5}T0{i % 9}:00:00", float(i), i) for i in range(3000)]
    raw = spark.createDataFrame(rows, "HourUTC string, SpotPriceEUR double, arrival long").repartition(8)
    from gridcast.operators.joins import price_series

    one = hourly_prices(price_series(raw))
    got = {r.price_time.strftime("%Y-%m-%dT%H:%M:%S"): r.label for r in one.collect()}
    want = {}
    for h, v, a in sorted(rows, key=lambda r: r[2]):
        want[h] = v  # last arrival wins
    assert got == want
