"""The prefix-sum backtest against a fit per origin, and fits with missing features and labels."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayledger.operators import demand as D
from stayledger.operators import models as M
from stayledger.operators.split import plan_time_folds


def months(n, start=2015 * 12):
    return [(i // 12) * 100 + i % 12 + 1 for i in range(start, start + n)]


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(2)
    rows = [
        (k, p, int(p % 100), float(50 * (k + 1) + 10 * np.sin(p % 100) + rng.integers(0, 9)))
        for k, n in enumerate((48, 40, 14, 5))
        for p in months(n)
    ]
    return spark.createDataFrame(rows, "place int, period int, month int, demand double")


@pytest.mark.parametrize("features", [D.FEATURES, ["lag_1"], ["lag_1", "lag_1"]])
def test_prefix_sums_equal_a_fit_per_origin(series, features):
    rows = D.origins(series, "period", "demand", ["place"], 18).toPandas()
    want = {}
    for p in sorted(rows.loc[rows.is_tested, "period"].unique()):
        past, now = rows[rows.period < p], rows[(rows.period == p) & rows.is_tested]
        x = np.hstack([past[features].to_numpy(), np.ones((len(past), 1))])
        w = np.linalg.lstsq(x, past["demand"].to_numpy(), rcond=None)[0]
        for r in now.itertuples():
            f = float(np.dot([getattr(r, c) for c in features], w[:-1]) + w[-1])
            want.setdefault(r.place, []).append((abs(r.demand - f), abs(r.demand - r.lag_12)))
    got = {r.place: r for r in D.backtest_linear(series, "period", "demand", ["place"], 18, features).collect()}
    assert set(got) == set(want) == {0, 1}
    for place, errors in want.items():
        model, naive = np.mean(errors, axis=0)
        assert got[place].n_points == len(errors)
        assert got[place].model_mae == pytest.approx(model, rel=1e-5)
        assert got[place].naive_mae == pytest.approx(naive)


def test_backtest_of_short_series_is_empty(series):
    assert D.backtest_linear(series.where("place = 3"), "period", "demand", ["place"]).count() == 0


@pytest.fixture(scope="module")
def holed(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=400)
    frame = pd.DataFrame({"id": range(400), "period": np.repeat(months(8), 50), "x": x, "z": rng.normal(size=400)})
    frame["y"] = (x + rng.normal(scale=0.5, size=400) > 0).astype(float)
    df = spark.createDataFrame(frame)
    return df.withColumns({
        "x": F.when(F.col("id") % 13 == 0, None).when(F.col("id") % 17 == 0, float("nan")).otherwise(F.col("x")),
        "y": F.when(F.col("id") % 19 == 0, None).otherwise(F.col("y")),
        "gone": F.lit(None).cast("double"),
    })


@pytest.mark.parametrize("make", [M.logistic, lambda: M.boosted(maxIter=3)])
def test_missing_features_do_not_end_a_fit(holed, make):
    plan = plan_time_folds(holed, "period", "id", k=3)
    scores = M.cv_scores(make, holed, plan, ["x", "z", "gone"], "y").collect()
    assert len(scores) == 3 and all(r.roc_auc > 0.75 for r in scores)
    labelled = holed.where("y IS NOT NULL").count()
    assert 0 < sum(r.n for r in scores) < labelled


def test_centers_come_from_known_values(holed):
    centers = M.train_centers(holed, ["x", "gone"])
    known = [r.x for r in holed.select("x").collect() if r.x is not None and not np.isnan(r.x)]
    assert centers["x"] == pytest.approx(np.mean(known)) and centers["gone"] == 0.0
    row = M.assemble(holed.where("id = 0"), ["x", "gone"], "y", centers={"x": 0.5}).first()
    assert list(row.features) == [0.5, 0.0]
