"""Training-data queries with SQL against DuckDB, the others for their rows."""

import duckdb
import pytest

from gridcast.llm.queries import ORACLE, QUERIES
from scripts.check_oracle import TABLES, norm_frame

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert norm_frame(got) == norm_frame(want)


@pytest.mark.parametrize("name", ["op1_personal_data", "op2_jaccard_join", "op3_toxicity", "op4_sharding", "op10_quality"])
def test_one_row_per_document(spark, name):
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
