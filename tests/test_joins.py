"""J1/J2 time-bucket join, hourly price de-duplication, size-checked broadcast."""

import datetime as dt

from gridcast.operators.joins import hour_join, hourly_prices, price_series, split_prices

T = dt.datetime


def prices(spark, rows):
    raw = spark.createDataFrame(rows, "HourUTC string, SpotPriceEUR double, arrival long")
    return price_series(raw)


def readings(spark, rows):
    return spark.createDataFrame(rows, "time_15min timestamp, temperature double, wind_speed double")


def test_join_each_quarter_to_its_hour(spark):
    w = readings(spark, [(T(2024, 1, 1, 10, m), 1.0, 2.0) for m in (0, 15, 30, 45)] + [(T(2024, 1, 1, 12, 0), 5.0, 5.0)])
    p = prices(spark, [("2024-01-01T10:00:00", 30.0, 1), ("2024-01-01T11:00:00", 40.0, 2)])
    out = hour_join(w, p.select("price_time", "label")).collect()
    assert len(out) == 4 and {r["label"] for r in out} == {30.0}  # 12:00 has no price -> dropped


def test_duplicate_hour_fans_out_unless_deduplicated(spark):
    w = readings(spark, [(T(2024, 1, 1, 10, 15), 1.0, 2.0)])
    p = prices(spark, [("2024-01-01T10:00:00", 30.0, 1), ("2024-01-01T10:00:00", 31.0, 2)])
    assert hour_join(w, p.select("price_time", "label")).count() == 2
    one = hourly_prices(p)
    out = hour_join(w, one).collect()
    assert len(out) == 1 and out[0]["label"] == 31.0  # latest arrival wins


def test_records_without_time_or_price_are_set_aside(spark):
    p = prices(spark, [("garbage", 10.0, 1), ("2024-01-01T10:00:00", None, 2), ("2024-01-01T11:00:00", float("nan"), 3)])
    assert hourly_prices(p).count() == 0
    priced, unpriced = split_prices(p)
    assert (priced.count(), unpriced.count()) == (0, 3)


def test_missing_price_never_replaces_one_and_off_hour_times_join_nothing(spark):
    p = prices(spark, [("2024-01-01T10:00:00", 10.0, 1), ("2024-01-01T10:00:00", None, 2), ("2024-01-01T11:30:00", 20.0, 3)])
    one = {r.price_time: r.label for r in hourly_prices(p).collect()}
    assert one == {T(2024, 1, 1, 10): 10.0, T(2024, 1, 1, 11, 30): 20.0}
    w = readings(spark, [(T(2024, 1, 1, h, 30), 1.0, 2.0) for h in (10, 11)])
    assert [r.label for r in hour_join(w, hourly_prices(p)).collect()] == [10.0]


def test_later_file_wins_before_position(spark):
    rows = [(T(2024, 1, 1, 10), 1.0, 5, 9), (T(2024, 1, 1, 10), 2.0, 7, 1), (T(2024, 1, 1, 10), 3.0, 7, 2)]
    p = spark.createDataFrame(rows, "price_time timestamp, label double, landed long, position long")
    assert [r.label for r in hourly_prices(p, arrival_cols=("landed", "position")).collect()] == [3.0]


def test_price_side_broadcast_only_under_bound(spark):
    w = readings(spark, [(T(2024, 1, 1, 10, 0), 1.0, 2.0)])
    p = prices(spark, [("2024-01-01T10:00:00", 30.0, 1)]).select("price_time", "label")
    small = hour_join(w, p, broadcast_max_rows=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = hour_join(w, p, broadcast_max_rows=0)
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert big.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_per_area_key(spark):
    w = spark.createDataFrame([(T(2024, 1, 1, 10, 0), 1.0, "A"), (T(2024, 1, 1, 10, 0), 2.0, "B")], "time_15min timestamp, temperature double, area string")
    p = spark.createDataFrame([(T(2024, 1, 1, 10, 0), 5.0, "A")], "price_time timestamp, label double, area string")
    out = hour_join(w, p, keys=("area",)).collect()
    assert [(r["area"], r["label"]) for r in out] == [("A", 5.0)]


def test_broadcast_also_bounded_in_bytes(spark):
    from gridcast.operators.sizing import bounded_broadcast, row_width

    n = 50_000
    side = spark.range(n, numPartitions=2).selectExpr("id AS k", "'xxxxxxxxxx' AS s")
    assert row_width(side) == 8 + 20
    _, rows = bounded_broadcast(side, max_rows=n, max_bytes=n * 28)
    assert rows == n
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fits, _ = bounded_broadcast(side, max_rows=n, max_bytes=n * 28)
        too_wide, _ = bounded_broadcast(side, max_rows=n, max_bytes=n * 28 - 1)
        left = spark.range(10).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in left.join(fits, "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in left.join(too_wide, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_join_count_is_sum_over_hours_of_products(spark):
    """J1 without de-duplication is a plain inner equi-join: sum over hours of
    (readings in the hour) x (price records for the hour)."""
    import random
    from collections import Counter

    rnd = random.Random(7)
    w_rows = [(T(2024, 1, 1, rnd.randrange(6), rnd.choice([0, 15, 30, 45])), 1.0, 1.0) for _ in range(80)]
    p_rows = [(f"2024-01-01T{rnd.randrange(8):02d}:00:00", float(i), i) for i in range(15)]
    nw = Counter(t.hour for t, _, _ in w_rows)
    np_ = Counter(int(h[11:13]) for h, _, _ in p_rows)
    want = sum(nw[h] * np_[h] for h in nw)
    got = hour_join(readings(spark, w_rows), prices(spark, p_rows).select("price_time", "label")).count()
    assert got == want


def test_unpivot_then_pivot_round_trip(spark):
    from gridcast.operators.views import GBT_LABEL, RF_LABEL, model_long, model_pivot

    rows = [(T(2024, 1, 2, h), float(h), 1.5 * h, h) for h in range(10)]
    wide = spark.createDataFrame(rows, "Time timestamp, price_rf double, price_gbt double, _arrival long")
    back = model_pivot(model_long(wide)).collect()
    assert [(r.Time, r[RF_LABEL], r[GBT_LABEL]) for r in back] == [(t, rf, gbt) for t, rf, gbt, _ in rows]


def test_wide_strings_count_by_their_files(spark):
    import random

    from gridcast.operators.sizing import bounded_broadcast

    rng = random.Random(0)
    wide = spark.createDataFrame([(i, "".join(rng.choices("0123456789abcdef", k=20_000))) for i in range(20)], "k int, s string")
    side, rows = bounded_broadcast(wide, max_bytes=100_000)
    assert rows == 20 and "broadcast" not in side._jdf.queryExecution().analyzed().toString().lower()
    side, _ = bounded_broadcast(wide, max_bytes=10_000_000)
    assert "broadcast" in side._jdf.queryExecution().analyzed().toString().lower()
