"""What shows all at once, what a second run replaces, and what a restart resumes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gridcast.jobs import load_prices, serve_job, silver_job
from gridcast.models.training import FIT_PARTITIONS, ROWS_PER_PARTITION, fit_one, fit_partitions
from gridcast.operators.joins import hour_join
from gridcast.operators.ordering import with_position
from gridcast.sources.bronze import commit_version, land_version, read_versions
from gridcast.sources.bucketed import bucketed_hour_join, write_by_hour
from gridcast.sources.quarantine import price_parts, read_bronze_text, weather_parts
from gridcast.sources.silver import merge_silver_hourly, read_silver
from gridcast.streaming import state
from gridcast.streaming.tiles import read_tiles, run_tiles, site_tiles

NOW = dt.datetime(2024, 1, 15, 12)
PRED = "time string, temperature double, wind_speed double, price_rf double, price_gbt double, arrival long, site string"


def predictions(spark, ids):
    rows = [((NOW + dt.timedelta(minutes=i % 300 - 60)).strftime("%Y-%m-%dT%H:%M:%S"), 1.0, 2.0, float(i), 1.5 * i, i, f"s{i % 3}") for i in ids]
    return spark.createDataFrame(rows, PRED)


def weather(times, temps, **more):
    return json.dumps({"latitude": 55.0, "longitude": 12.5, "hourly": {"time": times, "temperature_2m": temps, "windspeed_10m": [3.0] * len(times)}, **more})


def test_bronze_text_is_parsed_once_and_rejects_keep_text_and_place(spark, tmp_dir):
    good, partly = weather(["2024-01-01T00:00", "soon"], [1.0, 2.0]), weather(["2024-01-01T01:00"], ["cold"])
    lines = [good, "", "{broken", '{"error": true}', partly, "  "]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/bronze")
    parts = weather_parts(read_bronze_text(spark, f"{tmp_dir}/bronze"))
    assert sorted(r.value for r in parts["document"].collect()) == sorted(["{broken", '{"error": true}', partly])
    places = parts["document"].orderBy("task_row").collect()
    assert [r.task_row for r in places] == [2, 3, 4] and all("part-" in r.source_file and r.block_start == 0 for r in places)
    assert [(r.time_str, r.task_row) for r in parts["record"].collect()] == [("soon", 0)]
    kept = sorted(parts["good"].select(F.hour("time"), "temperature").collect())
    assert kept[0] == (0, 1.0) and len(kept) == 2


def test_price_lines_arrays_single_records_and_garbage(spark, tmp_dir):
    lines = ['[{"HourUTC": "2024-01-01T00:00:00", "SpotPriceEUR": 1.5}, {"HourUTC": "2024-01-01T01:00:00"}]', '{"HourUTC": "2024-01-01T02:00:00", "SpotPriceEUR": 2.5}', "[{oops", "[]"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/bronze")
    parts = price_parts(read_bronze_text(spark, f"{tmp_dir}/bronze"))
    assert sorted(r.label for r in parts["good"].collect()) == [1.5, 2.5]
    assert [r.HourUTC for r in parts["record"].collect()] == ["2024-01-01T01:00:00"]
    assert [r.value for r in parts["document"].collect()] == ["[{oops"]
    for _ in range(2):
        load_prices(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/bad", "a", dedupe=True)
    load_prices(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/bad", "b")
    for kind in ("prices", "price_documents"):
        assert sorted(r.run for r in spark.read.parquet(f"{tmp_dir}/bad/{kind}").collect()) == ["a", "b"]
    assert spark.read.parquet(f"{tmp_dir}/bad/prices").count() == 2


def test_second_silver_run_replaces_its_own_quarantine(spark, tmp_dir):
    spark.createDataFrame([(weather(["x", "2024-01-01T00:00"], [1.0, 2.0]),), ("no",)], "value string").write.text(f"{tmp_dir}/bronze")
    for _ in range(2):
        silver_job(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", show_schema=False)
    assert spark.read.parquet(f"{tmp_dir}/silver-quarantine/documents").count() == 1
    assert spark.read.parquet(f"{tmp_dir}/silver-quarantine/readings").count() == 1


def hourly(spark, rows, landed):
    at = dt.datetime(2024, 2, 1, 0, landed)
    return spark.createDataFrame([("a", t, 2.0, dt.datetime(2024, 1, 1, h), at) for h, t in rows], "site string, temperature double, wind_speed double, time timestamp, landed timestamp")


def test_merged_parts_keep_other_hours_and_the_last_landed_reading(spark, tmp_dir):
    silver = f"{tmp_dir}/silver"
    merge_silver_hourly(hourly(spark, [(0, 1.0), (1, 2.0)], 5), silver, keys=("site",))
    merge_silver_hourly(hourly(spark, [(1, 9.0), (2, 3.0)], 7), silver, keys=("site",))
    merge_silver_hourly(hourly(spark, [(2, -1.0), (3, 4.0)], 6), silver, keys=("site",))  # an older file, landed late
    got = read_silver(spark, silver).where(F.minute("time_15min") == 0).orderBy("time_15min").collect()
    assert [(r.time_15min.hour, r.temperature) for r in got] == [(0, 1.0), (1, 9.0), (2, 3.0), (3, 4.0)]
    assert read_silver(spark, silver).count() == 16


def test_a_landing_without_its_manifest_shows_the_old_answer(spark, tmp_dir):
    docs = lambda v: spark.createDataFrame([(v, "weather", "s", c) for c in ("a", "b")], "value string, kind string, site string, chunk string")
    base = f"{tmp_dir}/bronze"
    assert read_versions(spark, base).count() == 0
    land_version(docs("first"), base)
    stopped = "99999999999999999999-x"
    docs("second").where("chunk = 'a'").write.partitionBy("kind", "site", "chunk").text(f"{base}/data/landing={stopped}")
    seen = lambda: {r.chunk: r.value for r in read_versions(spark, base).collect()}
    assert seen() == {"a": "first", "b": "first"}
    commit_version(spark, base, stopped)
    assert seen() == {"a": "second", "b": "first"}


def test_a_reader_between_two_writes_sees_one_batch(spark, tmp_dir, monkeypatch):
    merge = state.keep_views(f"{tmp_dir}/state", "2024-01-15 12:00:00", "arrival")
    merge(predictions(spark, range(0, 100)), 0)
    before = {k: sorted(map(str, v.collect())) for k, v in state.read_views(spark, f"{tmp_dir}/state").items()}
    monkeypatch.setattr(state, "commit_views", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        merge(predictions(spark, range(100, 200)), 1)  # all three folders are written, the manifest is not
    assert {k: sorted(map(str, v.collect())) for k, v in state.read_views(spark, f"{tmp_dir}/state").items()} == before
    monkeypatch.undo()
    merge(predictions(spark, range(100, 200)), 1)  # the replay
    assert state.read_views(spark, f"{tmp_dir}/state")["current_conditions"].first().price == 179.0


def test_serving_keeps_bad_messages(spark, tmp_dir):
    good = json.dumps({"time": "2024-01-15T12:00:00", "price_rf": 5.0})
    spark.createDataFrame([(good,), ("oops",), ('{"time": "later"}',)], "value string").write.text(f"{tmp_dir}/inbox")
    serve_job(spark, f"{tmp_dir}/state", f"{tmp_dir}/chk", "files", inbox=f"{tmp_dir}/inbox", as_of="2024-01-15 12:00:00", available_now=True)
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/chk-quarantine").collect()) == ["oops", '{"time": "later"}']
    assert state.read_views(spark, f"{tmp_dir}/state")["current_conditions"].first().price == 5.0


def test_site_tiles_over_batches_and_a_restart_equal_the_table(spark, tmp_dir):
    whole = predictions(spark, range(600))
    for part in (range(0, 250), range(250, 600)):
        predictions(spark, part).repartitionByRange(2, "arrival").write.mode("append").parquet(f"{tmp_dir}/in")
        stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
        run_tiles(site_tiles(stream, "2024-01-15 12:00:00", delay="10 days"), f"{tmp_dir}/tiles", f"{tmp_dir}/chk")
    assert sorted(read_tiles(spark, f"{tmp_dir}/tiles").collect()) == sorted(site_tiles(whole, "2024-01-15 12:00:00").collect())


def test_position_is_the_place_in_the_whole_order(spark):
    df = spark.createDataFrame([(i * 37 % 100, f"v{i}") for i in range(100)] + [(None, "n")], "k int, v string")
    got = {r.v: r.position for r in with_position(df, ["k", "v"]).collect()}
    want = {v: n for n, (k, v) in enumerate(sorted(((r.k, r.v) for r in df.collect()), key=lambda x: (x[0] is not None, x)), 1)}
    assert got == want
    assert with_position(df.limit(0), ["k"]).count() == 0


def test_bucketed_join_needs_no_exchange(spark, tmp_dir):
    readings = spark.createDataFrame([(float(h), dt.datetime(2024, 1, 1, h, m)) for h in range(24) for m in (0, 15)], "temperature double, time_15min timestamp")
    prices = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, 0 if h % 5 else 30), float(h)) for h in range(24)] + [(dt.datetime(2024, 1, 1, 3), 7.0)], "price_time timestamp, label double")
    write_by_hour(readings, "t_readings", f"{tmp_dir}/r", "time_15min", 4)
    write_by_hour(prices, "t_prices", f"{tmp_dir}/p", "price_time", 4)
    joined = bucketed_hour_join(spark, "t_readings", "t_prices")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    cols = ["temperature", "time_15min", "label"]
    assert sorted(joined.select(*cols).collect()) == sorted(hour_join(readings, prices).select(*cols).collect())


def test_fit_partitions_follow_the_rows_and_not_their_layout(spark):
    assert fit_partitions(0) == fit_partitions(1000) == FIT_PARTITIONS
    assert fit_partitions(100 * ROWS_PER_PARTITION) == 100
    rows = [(float(i % 17), float(i % 5), i % 24, i % 7 + 1, float(i % 11)) for i in range(400)]
    df = spark.createDataFrame(rows, "temperature double, wind_speed double, hour_of_day int, day_of_week int, label double")
    models = [fit_one(x, "rf") for x in (df.repartition(3), df.repartition(7).orderBy(F.desc("label")))]
    assert models[0].stages[1].toDebugString.split("\n")[1:] == models[1].stages[1].toDebugString.split("\n")[1:]
