"""C5 month chunks."""

import datetime as dt

from gridcast.operators.calendar import month_chunks

D = dt.date


def chunks(spark, start, end):
    df = spark.createDataFrame([(start, end)], "start date, `end` date")
    return [(r.chunk_start, r.chunk_end, r.tag) for r in month_chunks(df).orderBy("chunk_start").collect()]


def test_full_year_twelve_chunks(spark):
    out = chunks(spark, D(2023, 1, 1), D(2023, 12, 31))
    assert len(out) == 12
    assert out[1] == (D(2023, 2, 1), D(2023, 2, 28), "2023_02")
    assert out[-1] == (D(2023, 12, 1), D(2023, 12, 31), "2023_12")


def test_leap_february_and_mid_month_bounds(spark):
    out = chunks(spark, D(2024, 1, 20), D(2024, 3, 10))
    assert out == [
        (D(2024, 1, 20), D(2024, 1, 31), "2024_01"),
        (D(2024, 2, 1), D(2024, 2, 29), "2024_02"),
        (D(2024, 3, 1), D(2024, 3, 10), "2024_03"),
    ]


def test_request_text(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 31))], "start date, `end` date")
    r = month_chunks(df).first()
    assert (r.start_text, r.end_text) == ("2024-01-01", "2024-01-31")
