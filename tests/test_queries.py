"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from gridcast.plans.catalog import QUERIES
from gridcast.plans.catalog_stream import STREAM_QUERIES
from scripts.check_oracle import TABLES, norm_frame

SF = "/root/testdata/sf0.001"
NAMES = {**QUERIES, **STREAM_QUERIES}  # the training-data queries have tests of their own
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in NAMES}
ROWS_ONLY = sorted(set(NAMES) - set(ORACLE))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["temperature", "wind_speed", "label", "time_15min", "hour_of_day", "day_of_week"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck.execute(ORACLE[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert norm_frame(got) == norm_frame(want)


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_score_every_message(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() == spark.read.parquet(f"{SF}/events.parquet").count()
