import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayledger.operators import lookup
from stayledger.operators.ordering import (
    exact_quantiles,
    order_statistics,
    range_splits,
    row_positions,
    running_totals,
    with_range,
)

FRACTIONS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def make(name):
    rng = random.Random(5)
    n = 20_000
    return {
        "uniform": [rng.random() for _ in range(n)],
        "hot": [0.0 if rng.random() < 0.6 else rng.random() for _ in range(n)],
        "heavy_tail": [rng.paretovariate(0.5) for _ in range(n)],
        "constant": [3.0] * n,
        "few": [float(rng.randint(0, 4)) for _ in range(n)],
    }[name]


@pytest.mark.parametrize("name", ["uniform", "hot", "heavy_tail", "constant", "few"])
@pytest.mark.parametrize("limit", [50, 10**6])
def test_quantiles_are_exact_on_both_paths(spark, name, limit):
    """A small sort limit forces the narrowing that large tables go through."""
    data = make(name)
    df = spark.createDataFrame([(v,) for v in data], "x double").repartition(6)
    got = exact_quantiles(df, ["x"], FRACTIONS, limit=limit)["x"]
    assert got.n == len(data)
    assert np.allclose(got.values, np.quantile(data, FRACTIONS), rtol=1e-12, atol=1e-12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.integers(-10**6, 10**6)), min_size=0, max_size=80))
def test_order_statistics_match_sorted(spark, data):
    df = spark.createDataFrame([(v,) for v in data], "x bigint")
    kept = sorted(v for v in data if v is not None)
    counts, found = order_statistics(df, {"x": F.col("x")}, lambda _n, n: range(n), limit=5)
    assert counts["x"] == len(kept)
    assert [found["x"][r] for r in range(len(kept))] == kept


def test_running_totals_cross_ranges(spark):
    data = [(i % 97 / 10.0, 1) for i in range(5000)]
    df = spark.createDataFrame(data, "v double, one int")
    groups = df.groupBy("v").agg(F.sum("one").alias("n"))
    cut = with_range(groups, "v", range_splits(df, {"v": F.col("v")}, 16)["v"], "_range")
    for descending in (False, True):
        rows = running_totals(cut, "v", ["n"], descending=descending).collect()
        rows.sort(key=lambda r: r.v, reverse=descending)
        assert [r.cum_n for r in rows] == list(np.cumsum([r.n for r in rows]))


def test_positions_follow_the_order_with_one_hot_period(spark):
    rows = [(200001 if i % 3 else 200002, (i * 7919) % 3001) for i in range(3001)]
    df = spark.createDataFrame(rows, "period int, id bigint").repartition(5)
    got = {(r.period, r.id): r.position for r in row_positions(df, ["period"], "id").collect()}
    assert [got[k] for k in sorted(rows)] == list(range(len(rows)))


def test_range_of_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert range_splits(df, {"x": F.col("x")}) == {"x": []}
    assert exact_quantiles(df, ["x"], [0.5])["x"].values == [None]


def test_lookup_paths_agree(spark):
    """Broadcast and shuffled lookups give the same rows; the hot level does not change that."""
    df = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), F.col("id") % 50)).alias("k")
    )
    state = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.avg("id").alias("value")).where("k <> 'l7'")
    small = lookup.attach(df, state, ["k"])
    large = lookup.attach(df, state, ["k"], broadcast_rows=3, hot_share=10)
    key = ["id", "k", "value"]
    assert sorted(map(tuple, small.select(key).collect()), key=str) == sorted(
        map(tuple, large.select(key).collect()), key=str
    )
    plan = large._jdf.queryExecution().toString()
    assert "_salt" in plan


@pytest.mark.parametrize("limit", [10, 10**6])
def test_not_a_number_is_missing_and_infinity_is_a_value(spark, limit):
    data = [float(i) for i in range(200)] + [float("inf")] * 60 + [float("-inf")] * 60
    df = spark.createDataFrame([(v,) for v in [*data, *[float("nan")] * 30, None]], "x double")
    want = sorted(data)
    ranks = [0, 59, 60, 150, 259, 260, 319]
    counts, found = order_statistics(df, {"x": F.col("x")}, lambda _n, _c: ranks, limit=limit)
    assert counts["x"] == len(want)
    assert [found["x"][r] for r in ranks] == [want[r] for r in ranks]
    assert all(np.isfinite(range_splits(df, {"x": F.col("x")}, 8)["x"]))
