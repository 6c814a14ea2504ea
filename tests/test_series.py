"""C1 flatten (S1, P1-P3, X1, B1) and C2 upsample."""

import datetime as dt
import json

from pyspark.sql import functions as F

from gridcast.operators.quality import split_valid
from gridcast.operators.series import flatten_series, hold_offsets, upsample_hold
from gridcast.sources.bronze import parse_weather_docs, read_weather_docs


def docs(spark, *objs):
    return parse_weather_docs(spark.createDataFrame([(json.dumps(o),) for o in objs], "value string"))


def test_flatten_both_wind_names_and_error_doc(spark):
    d = docs(
        spark,
        {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.0, 2.5], "windspeed_10m": [3.0, 4.5]}},
        {"hourly": {"time": ["2024-01-02T00:00"], "temperature_2m": [7.0], "wind_speed_10m": [8.0]}},
        {"error": True, "reason": "bad request"},
    )
    rows = sorted(flatten_series(d).select("time_str", "temperature", "wind_speed").collect())
    assert [tuple(r) for r in rows] == [
        ("2024-01-01T00:00", 1.0, 3.0),
        ("2024-01-01T01:00", 2.5, 4.5),
        ("2024-01-02T00:00", 7.0, 8.0),
    ]


def test_flatten_ragged_arrays_pad_with_null(spark):
    d = docs(spark, {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T02:00"], "temperature_2m": [1.0, None], "windspeed_10m": [3]}})
    rows = flatten_series(d).orderBy("time_str").select("temperature", "wind_speed").collect()
    assert [tuple(r) for r in rows] == [(1.0, 3.0), (None, None), (None, None)]


def test_flatten_missing_wind_array_keeps_rows(spark):
    d = docs(spark, {"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1.0]}})
    assert [tuple(r) for r in flatten_series(d).select("temperature", "wind_speed").collect()] == [(1.0, None)]


def test_bad_time_goes_to_quarantine(spark):
    d = docs(spark, {"hourly": {"time": ["2024-01-01T00:00", "not a time"], "temperature_2m": [1.0, 2.0], "windspeed_10m": [1.0, 2.0]}})
    good, bad = split_valid(flatten_series(d), ["time"])
    assert good.count() == 1 and bad.count() == 1
    assert bad.first()["time_str"] == "not a time"


def test_whole_numbers_stay_double(spark, tmp_dir):
    path = f"{tmp_dir}/weather_2024_01.json"
    spark.createDataFrame([(json.dumps({"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1], "windspeed_10m": [2]}}),)], "v string").write.text(path)
    flat = flatten_series(read_weather_docs(spark, f"{tmp_dir}/weather*.json"))
    assert dict(flat.dtypes)["temperature"] == "double"
    assert flat.first()["wind_speed"] == 2.0


def test_flatten_row_count_is_sum_of_lengths(spark):
    objs = [{"hourly": {"time": [f"2024-01-01T{h:02d}:00" for h in range(n)], "temperature_2m": [0.0] * n, "windspeed_10m": [0.0] * n}} for n in (0, 1, 5, 24)]
    assert flatten_series(docs(spark, *objs)).count() == 30


def test_upsample_times_four_same_values(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 0), 1.5, 2.5)], "time timestamp, temperature double, wind_speed double")
    out = upsample_hold(df).orderBy("time_15min").collect()
    assert [r["time_15min"] for r in out] == [dt.datetime(2024, 1, 1, 23, m) for m in (0, 15, 30, 45)]
    assert {(r["temperature"], r["wind_speed"]) for r in out} == {(1.5, 2.5)}
    assert set(upsample_hold(df).columns) == {"temperature", "wind_speed", "time_15min"}


def test_upsample_crosses_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 30), 1.0)], "time timestamp, temperature double")
    out = [r["time_15min"] for r in upsample_hold(df).orderBy("time_15min").collect()]
    assert out[-1] == dt.datetime(2024, 1, 2, 0, 15)


def test_upsample_other_steps(spark):
    assert hold_offsets(30) == [0, 30]
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0)], "time timestamp, v double")
    assert upsample_hold(df, step_minutes=5).count() == 12
    assert upsample_hold(df).select(F.minute("time_15min")).distinct().count() == 4


def test_silver_shuffles_hourly_rows_and_files_each_quarter_by_its_day(spark, tmp_dir):
    import re

    from gridcast.sources.silver import read_silver, write_silver_hourly

    hourly = spark.createDataFrame(
        [(1.0, 2.0, dt.datetime(2024, 1, 1, 23, 30)), (3.0, 4.0, dt.datetime(2024, 1, 2, 5, 0))],
        "temperature double, wind_speed double, time timestamp",
    )
    out = write_silver_hourly(hourly, f"{tmp_dir}/silver")
    plan = re.sub(r"#\d+", "", out._jdf.queryExecution().executedPlan().toString())
    assert plan.index("Generate explode") < plan.index("REBALANCE_PARTITIONS_BY_COL")  # upsample above the exchange
    back = read_silver(spark, f"{tmp_dir}/silver")
    by_day = sorted((str(r.date), r.time_15min.strftime("%H:%M")) for r in back.collect())
    assert by_day == [
        ("2024-01-01", "23:30"), ("2024-01-01", "23:45"),
        ("2024-01-02", "00:00"), ("2024-01-02", "00:15"),
        ("2024-01-02", "05:00"), ("2024-01-02", "05:15"), ("2024-01-02", "05:30"), ("2024-01-02", "05:45"),
    ]
