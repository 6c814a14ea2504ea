"""Plan shapes that make the registered queries scale (checked on the physical plan).

A filter reaching the Parquet scan, a top-k instead of a global sort, a
partial window limit before the shuffle, a map-side partial aggregate, and
the size-checked broadcast of the price side.
"""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = entry.queries()[name](spark, SF)
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_range_filter_reaches_the_scan_and_columns_are_pruned(spark):
    p = plan(spark, "date_range")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "LessThan(ts," in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in p


def test_location_filter_pushed(spark):
    assert "EqualTo(user_id,7)" in plan(spark, "location_filter")


def test_training_join_broadcasts_the_checked_price_side(spark):
    p = plan(spark, "training_set")
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p


def test_per_area_top_20_limited_before_the_shuffle(spark):
    p = plan(spark, "latest_valid_by_area")
    partial = p.index("WindowGroupLimit [PriceArea]")
    assert "Partial" in p and "Final" in p
    assert p.index("Exchange hashpartitioning(PriceArea") < p.rindex("WindowGroupLimit")
    assert partial >= 0


@pytest.mark.parametrize("name", ["live_series", "latest_valid", "peek_one"])
def test_top_k_is_take_ordered(spark, name):
    p = plan(spark, name)
    if name == "peek_one":
        assert "TakeOrderedAndProject(limit=1" in p
    else:
        assert "TakeOrderedAndProject" in p
    assert "RoundRobinPartitioning(1)" not in p and "SinglePartition" not in p


def test_hourly_dedupe_combines_map_side(spark):
    p = plan(spark, "hourly_prices")
    assert "partial_max_by" in p
    assert p.index("Exchange hashpartitioning") < p.index("partial_max_by")


def test_distinct_combines_map_side(spark):
    p = plan(spark, "distinct_rows")
    assert p.count("HashAggregate(keys=[user_id, event_type]") == 2


def test_no_python_in_any_batch_plan(spark):
    for name in ["training_set", "current_conditions", "live_series", "model_comparison", "json_parse", "trade_signal",
                 "forecast_messages", "live_messages", "market_messages", "upsample_sql"]:
        p = plan(spark, name)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_silver_date_range_prunes_partitions(spark):
    p = plan(spark, "silver_date_range")
    assert "PartitionFilters: [isnotnull(date)" in p
    assert "2024-01-10" in p and "2024-01-12" in p


def test_serving_windows_reach_the_scan(spark):
    for name in ("fresh_rows", "current_conditions", "live_series"):
        text = plan(spark, name)
        assert "GreaterThan(ts,2024-01-1" in text and "LessThan(ts,2024-01-1" in text, name
    assert "GreaterThan(ts,2024-01-15" in plan(spark, "model_unpivot")
