"""Producers' data logic (P4, P11-P14, C6 output) and SQL upsample."""

import datetime as dt
import json

from pyspark.sql import functions as F

from gridcast.operators.readings import (
    FORECAST_SOURCE,
    LIVE_SOURCE,
    forecast_readings,
    live_readings,
    market_messages,
    with_fetch_stamp,
)
from gridcast.operators.series import upsample_hold, upsample_hold_sql
from gridcast.sources.bronze import parse_live_docs, parse_weather_docs


def text(spark, *objs):
    return spark.createDataFrame([(json.dumps(o),) for o in objs], "value string")


def test_forecast_document_to_one_reading_per_hour(spark):
    docs = parse_weather_docs(
        text(
            spark,
            {"hourly": {"time": ["2025-12-30T10:00", "2025-12-30T11:00"], "temperature_2m": [5.0, 6.0], "wind_speed_10m": [3.0, 4.0]}},
            {"latitude": 55.4, "hourly": {"time": ["2025-12-31T00:00"], "temperature_2m": [1.0], "windspeed_10m": [2.0]}},
        )
    )
    got = sorted(tuple(r) for r in forecast_readings(docs).collect())
    assert got == [
        ("2025-12-30T10:00", 5.0, 3.0, FORECAST_SOURCE),
        ("2025-12-30T11:00", 6.0, 4.0, FORECAST_SOURCE),
        ("2025-12-31T00:00", 1.0, 2.0, FORECAST_SOURCE),
    ]


def test_forecast_short_array_gives_null_reading(spark):
    docs = parse_weather_docs(text(spark, {"hourly": {"time": ["2025-12-30T10:00", "2025-12-30T11:00"], "temperature_2m": [5.0], "wind_speed_10m": [3.0, 4.0]}}))
    rows = forecast_readings(docs).orderBy("time").collect()
    assert [r.temperature for r in rows] == [5.0, None]


def test_live_document_stamped_with_fetch_time(spark):
    docs = parse_live_docs(
        text(spark, {"current": {"time": "2024-01-01T10:00", "temperature_2m": 4.5, "wind_speed_10m": 7.0}, "extra": 1}).withColumn(
            "fetched", F.lit(dt.datetime(2024, 3, 1, 8, 9, 10, 500000))
        ),
        keep=["fetched"],
    )
    row = live_readings(docs, stamp="fetched").first()
    assert tuple(row) == ("2024-03-01T08:09:10", 4.5, 7.0, LIVE_SOURCE)


def test_live_document_default_stamp_is_processing_time(spark):
    docs = parse_live_docs(text(spark, {"current": {"temperature_2m": 1.0, "wind_speed_10m": None}}))
    row = live_readings(docs).first()
    assert row.wind_speed is None
    stamp = dt.datetime.strptime(row.time, "%Y-%m-%dT%H:%M:%S")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((stamp - now).total_seconds()) < 600


def test_fetch_stamp_is_epoch_seconds(spark):
    df = spark.createDataFrame([(1,)], "a int")
    row = with_fetch_stamp(df, at=F.lit("2024-01-15 12:00:00").cast("timestamp")).first()
    assert row.fetched_at == 1705320000.0


def test_market_messages_per_area_limit_before_filter(spark):
    # area A: newest priced record sits at place 3; area B: its only priced
    # record is older than its 2 newest, so B sends nothing (depth 2).
    rows = [
        ("A", "2024-01-01T05:00:00", None, 5),
        ("A", "2024-01-01T04:00:00", None, 4),
        ("A", "2024-01-01T03:00:00", 42.0, 3),
        ("B", "2024-01-01T05:00:00", None, 15),
        ("B", "2024-01-01T04:00:00", None, 14),
        ("B", "2024-01-01T03:00:00", 7.0, 13),
    ]
    df = spark.createDataFrame(rows, "PriceArea string, TimeUTC string, ImbalancePriceEUR double, arrival long")
    at = F.lit("2024-01-01 06:00:00").cast("timestamp")
    deep = {r.PriceArea: (r.ImbalancePriceEUR, r.fetched_at) for r in market_messages(df, depth=3, tie_col="arrival", at=at).collect()}
    assert deep == {"A": (42.0, 1704088800.0), "B": (7.0, 1704088800.0)}
    shallow = market_messages(df, depth=2, tie_col="arrival", at=at).collect()
    assert shallow == []


def test_sql_upsample_equals_dataframe_upsample(spark):
    rows = [(1.0, 2.0, dt.datetime(2024, 1, 1, 23)), (3.0, None, dt.datetime(2024, 1, 2, 0))]
    df = spark.createDataFrame(rows, "temperature double, wind_speed double, time timestamp")
    a = sorted(tuple(r) for r in upsample_hold(df).collect())
    b = sorted(tuple(r) for r in upsample_hold_sql(df).collect())
    assert a == b and len(a) == 8
    assert upsample_hold_sql(df).columns == ["temperature", "wind_speed", "time_15min"]


def test_sql_upsample_views_do_not_collide(spark):
    one = spark.createDataFrame([(1.0, dt.datetime(2024, 1, 1))], "temperature double, time timestamp")
    two = spark.createDataFrame([(2.0, dt.datetime(2024, 1, 2))], "temperature double, time timestamp")
    a, b = upsample_hold_sql(one), upsample_hold_sql(two)
    assert {r.temperature for r in a.collect()} == {1.0}
    assert {r.temperature for r in b.collect()} == {2.0}


def test_sql_upsample_leaves_no_view_behind(spark):
    df = spark.createDataFrame([(1.0, dt.datetime(2024, 1, 1))], "temperature double, time timestamp")
    before = {t.name for t in spark.catalog.listTables()}
    out = upsample_hold_sql(df)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert out.count() == 4
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(sequence(" in plan and "Exchange" not in plan
