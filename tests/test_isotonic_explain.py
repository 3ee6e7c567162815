"""Isotonic map against one pass over all points, correlations against numpy, explanations of any model."""

import bisect
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.operators import explain, models
from stayledger.operators.isotonic import IsotonicMap, fit_isotonic
from stayledger.operators.profile import corr_matrix


def plain_map(points):
    """Largest over starts of the smallest mean over ends: the definition, without pooling."""
    xs = sorted({x for x, _ in points})
    totals = [[sum(y for x2, y in points if x2 == x), sum(1 for x2, _ in points if x2 == x)] for x in xs]
    cum = np.cumsum([[0, 0], *totals], axis=0)
    mean = [
        [(cum[k + 1][0] - cum[j][0]) / (cum[k + 1][1] - cum[j][1]) if k >= j else 0.0 for k in range(len(xs))]
        for j in range(len(xs))
    ]
    fitted = [max(min(mean[j][k] for k in range(i, len(xs))) for j in range(i + 1)) for i in range(len(xs))]

    def at(x):
        if x <= xs[0]:
            return fitted[0]
        if x >= xs[-1]:
            return fitted[-1]
        i = bisect.bisect_right(xs, x) - 1
        share = (x - xs[i]) / (xs[i + 1] - xs[i])
        return fitted[i] + share * (fitted[i + 1] - fitted[i])

    return at


def scored(spark, points):
    return spark.createDataFrame(points, "p double, y int")


KINDS = {
    "noisy": lambda r, x: int(r.random() < x),
    "falling": lambda r, x: int(r.random() > x),
    "flat": lambda r, x: 1,
    "perfect": lambda r, x: int(x > 0.5),
    "wave": lambda r, x: int(r.random() < 0.5 + 0.4 * math.sin(12 * x)),
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("pool_rows", [5, 1000])
def test_map_equals_the_definition(spark, kind, pool_rows):
    rng = random.Random(kind)
    xs = [round(rng.random(), rng.choice([2, 12])) for _ in range(120)]
    points = [(x, KINDS[kind](rng, x)) for x in xs]
    at = plain_map(points)
    fitted = fit_isotonic(scored(spark, [*points, (None, 1), (float("nan"), 0), (0.3, None)]), "y", "p", pool_rows)
    asked = [-1.0, 2.0, *xs[:40], *[rng.random() for _ in range(60)]]
    df = spark.createDataFrame([(x,) for x in asked] * 2, "p double")
    for inline in (10_000, 0):  # searched in place, and joined
        got = fitted.apply(df, "p", "q", inline).collect()
        assert len(got) == 2 * len(asked)
        for r in got:
            assert r.q == pytest.approx(at(r.p), abs=1e-9)


def test_map_of_odd_tables(spark, tmp_path):
    none = fit_isotonic(scored(spark, []), "y", "p")
    asked = spark.createDataFrame([(0.5,), (None,), (float("nan"),)], "p double")
    for inline in (10_000, -1):
        assert [r.q for r in none.apply(asked, "p", "q", inline).collect()] == [None] * 3
    one = fit_isotonic(scored(spark, [(0.4, 1), (0.4, 0)]), "y", "p")
    path = str(tmp_path / "map")
    one.save(path)
    again = IsotonicMap.load(spark, path)
    for inline in (10_000, 0):
        got = again.apply(asked, "p", "q", inline).collect()
        assert sorted([r.q for r in got], key=lambda v: v is None) == [0.5, None, None]


def test_correlations_equal_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 60)) + 1e6 * (np.arange(60) % 3)
    x[:, 1] += x[:, 0]
    x[:, 7] = 4.1
    holes = rng.random(x.shape) < 0.1
    names = [f"f.{i}" for i in range(60)]
    rows = [tuple(None if h else float(v) for v, h in zip(r, g, strict=True)) for r, g in zip(x, holes, strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names))
    df = df.toDF(*[n.replace(".", "_") for n in names]).repartition(5)
    names = df.columns
    out = corr_matrix(df, names)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "corr(" not in plan and len(plan) < 60_000
    got = {(r.feature, r.other): r["corr"] for r in out.collect()}
    assert len(got) == 3600 and got["f_7", "f_1"] is None and got["f_7", "f_7"] is None and got["f_0", "f_0"] == 1.0
    for i, j in [(0, 1), (1, 0), (2, 5), (58, 59), (10, 40)]:
        both = ~holes[:, i] & ~holes[:, j]
        want = np.corrcoef(x[both, i], x[both, j])[0, 1]
        assert got[names[i], names[j]] == pytest.approx(want, abs=1e-9)
    assert corr_matrix(df.limit(0), names[:2]).where("corr is not null").count() == 0


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(300):
        a, b, c = rng.gauss(0, 1), rng.gauss(3, 2), rng.gauss(0, 1)
        y = int(rng.random() < 1 / (1 + math.exp(-(2 * a - (b - 3)))))
        data.append((i, y, a, b if i % 10 else None, c))
    return spark.createDataFrame(data, "id bigint, y int, a double, b double, c double")


def test_occlusion_of_a_linear_model_is_its_contribution(rows):
    features = ["a", "b", "c"]
    centers = models.train_centers(rows, features)
    fit_rows = models.with_pos_weight(models.assemble(rows, features, "y", centers=centers))
    model = models.logistic(regParam=0.01).fit(fit_rows)
    exact = {r.id: r for r in explain.explain_model(model, rows, "id", features, centers).collect()}
    hidden = explain.occlusion(model, rows, "id", features, centers).collect()
    assert len(hidden) == len(exact) == 300
    for r in hidden:
        for f in (*features, *[f + explain.SUFFIX for f in features], explain.LOGIT):
            assert r[f] == pytest.approx(exact[r.id][f], abs=1e-6)


def test_occlusion_of_trees_is_a_difference_of_scores(rows):
    features = ["a", "b", "c"]
    centers = models.train_centers(rows, features)
    model = models.boosted(maxIter=5, maxDepth=3).fit(
        models.with_pos_weight(models.assemble(rows, features, "y", centers=centers))
    )
    got = {r.id: r for r in explain.explain_model(model, rows, "id", features, centers).collect()}

    def logits(df):
        p = models.positive_score(model, models.assemble(df, features, "y", ["id"], centers))
        return {r.id: math.log(r.p / (1 - r.p)) for r in p.select("id", "p").collect()}

    base = logits(rows)
    for f in features:
        without = logits(rows.withColumn(f, F.lit(centers[f])))
        for i, r in got.items():
            assert r[f + explain.SUFFIX] == pytest.approx(base[i] - without[i], abs=1e-6)
    ends = explain.extreme_examples(
        explain.explain_model(model, rows, "id", features, centers), "id", features, 2
    ).collect()
    assert base[ends[0].id] == pytest.approx(max(base.values())) and len(ends[0].top) == 2
