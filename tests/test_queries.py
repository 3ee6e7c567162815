"""Every registered query against its SQL twin on the smallest tables, with negative controls."""

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    if name not in ORACLES:
        assert df.count() > 0
        return
    problems = [p for p in compare(df, duck, ORACLES[name]) if p != "oracle is empty"]
    assert not problems


def test_entry_runs(spark):
    rows = entry_point.entry(spark).collect()
    assert len(rows) == 5


@pytest.mark.parametrize("name", ["rate_by_category", "drift_report", "target_encode", "best_price", "stream_scored"])
def test_comparison_notices_a_change(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    number = next(f.name for f in df.schema if f.dataType.typeName() == "double")
    assert compare(df.withColumn(number, F.col(number) + 0.01), duck, ORACLES[name])
    assert compare(df.limit(max(df.count() - 1, 0)), duck, ORACLES[name])
