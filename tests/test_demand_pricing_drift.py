import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.operators import demand as D
from stayledger.operators import drift as R
from stayledger.operators import monitoring as M
from stayledger.operators import pricing as P


@pytest.fixture(scope="module")
def series(spark):
    rows = []
    for i in range(48):
        period = (2015 + i // 12) * 100 + i % 12 + 1
        gross = 100 + 10 * (i % 12) + i
        rows.append(("x", period, gross, 20, gross - 20, period // 100, period % 100))
    return spark.createDataFrame(rows, "k string, period int, gross_bookings bigint, cancellations bigint, realised_demand bigint, year int, month int").cache()


def test_series_identity(spark):
    df = spark.range(500).select((201501 + F.col("id") % 12).cast("int").alias("period"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    out = D.demand_series(df, "period", "y").collect()
    assert sum(r.gross_bookings for r in out) == 500
    assert all(r.realised_demand == r.gross_bookings - r.cancellations for r in out)


def test_gaps_become_zero_months(spark):
    df = spark.createDataFrame([(201511, 5, 1, 4), (201602, 7, 2, 5)], "period int, gross_bookings bigint, cancellations bigint, realised_demand bigint")
    rows = D.densify(df.withColumns({"year": F.lit(0), "month": F.lit(0)}), "period").orderBy("period").collect()
    assert [(r.period, r.gross_bookings) for r in rows] == [(201511, 5), (201512, 0), (201601, 0), (201602, 7)]
    assert [r.month for r in rows] == [11, 12, 1, 2]


def test_lags_and_rolls_look_back_only(series):
    rows = D.with_time_features(series, "period", keys=["k"]).orderBy("period").collect()
    demand = [r.realised_demand for r in rows]
    assert rows[0].lag_1 is None and rows[5].lag_1 == demand[4] and rows[12].lag_12 == demand[0]
    assert rows[2].roll_mean_3 is None and rows[3].roll_mean_3 == pytest.approx(np.mean(demand[:3]))
    assert rows[5].roll_mean_6 is None and rows[6].roll_mean_6 == pytest.approx(np.mean(demand[:6]))


def test_errors(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 180.0), (5.0, None)], "a double, f double")
    row = D.forecast_errors(df, "a", "f").first()
    assert row.mae == 15.0 and row.mape == pytest.approx(10.0) and row.n_points == 2


def linear(label):
    from pyspark.ml.regression import LinearRegression

    return LinearRegression(featuresCol="features", labelCol=label, regParam=0.0)


def test_backtest_compares_on_the_same_points(series):
    row = D.backtest_model(series, "period", keys=["k"], make=linear).first()
    assert row.n_points == 18 and row.naive_mae == pytest.approx(12.0)
    assert row.model_mae < row.naive_mae and row.model_beats_naive
    naive = D.backtest_naive(series, "period", keys=["k"]).first()
    assert naive.n_points == 18 and naive.mae == pytest.approx(12.0)


def test_forecast_is_for_the_period_after_the_last(series):
    out = D.forecast_next(series, "period", keys=["k"], make=linear).collect()
    assert len(out) == 1 and out[0].period == 201901
    assert out[0].forecast == pytest.approx(128, abs=5)


def test_short_series_get_a_forecast(spark, series):
    short = spark.createDataFrame(
        [("y", 201811, 4, 1, 3, 2018, 11), ("y", 201812, 8, 1, 7, 2018, 12), ("z", 201805, 9, 0, 9, 2018, 5)],
        series.schema,
    )
    both = D.forecast_next(series.unionByName(short), "period", keys=["k"], make=linear).collect()
    got = {r.k: (r.period, r.by_model) for r in both}
    assert got == {"x": (201901, True), "y": (201901, False), "z": (201806, False)}
    assert {r.k: r.forecast for r in both if r.k != "x"} == {"y": 5.0, "z": 9.0}
    only = D.forecast_next(short, "period", keys=["k"], make=linear).collect()
    assert {r.k: r.forecast for r in only} == {"y": 5.0, "z": 9.0}


# --- pricing


def entity(spark, demand=1000.0, ref=110.0, cancel=0.33):
    return spark.createDataFrame([(demand, ref, cancel)], "base_demand double, ref_price double, base_cancel double")


def test_grid_and_bound_optima(spark):
    e = entity(spark)
    curve = P.price_curve(e).orderBy("step").collect()
    assert len(curve) == 100
    assert curve[0].price == pytest.approx(66.0) and curve[33].price == pytest.approx(110.0)
    assert curve[99].price == pytest.approx(198.0)
    low, high = (P.best_price(e, F.lit(x)).first() for x in (-1.2, -0.8))
    assert (low.recommended_price, low.optimum_at_price_bound) == (66.0, True)
    assert (high.recommended_price, high.optimum_at_price_bound) == (198.0, True)


def test_inner_optimum_with_unit_cost(spark):
    best = P.best_price(entity(spark), F.lit(-3.0), unit_cost=F.lit(60.0)).first()
    assert not best.optimum_at_price_bound and 66 < best.recommended_price < 198
    assert best.expected_revenue_at_recommended >= best.expected_revenue_at_reference


def test_first_price_wins_ties(spark):
    flat = P.best_price(entity(spark, demand=0.0)).first()
    assert flat.recommended_price == 66.0 and flat.revenue_uplift_pct == 0.0


def test_sweep_and_period_price(spark):
    swept = P.elasticity_sweep(entity(spark), [-0.8, -1.2, -2.0]).collect()
    assert {r.elasticity: r.recommended_price for r in swept} == {-0.8: 198.0, -1.2: 66.0, -2.0: 66.0}
    forecasts = spark.createDataFrame([("a", 80.0)], "k string, forecast double")
    rates = spark.createDataFrame([("a", 0.2, 5)], "k string, base_cancel double, n_bookings bigint")
    gross = P.price_for_period(forecasts, rates, ["k"], F.lit(100.0)).first()
    net = P.price_for_period(forecasts, rates, ["k"], F.lit(100.0), demand_is_net=True).first()
    assert net.expected_revenue_at_reference == pytest.approx(gross.expected_revenue_at_reference / 0.8, abs=0.01)


# --- drift


def numbers(spark, values):
    return spark.createDataFrame([(float(v),) if v is not None else (None,) for v in values], "x double")


def brute_psi(ref, cur, bins=10):
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)))
    inner = edges[1:-1]
    r = np.bincount(np.searchsorted(inner, ref, side="right"), minlength=len(inner) + 1) / len(ref) + 1e-6
    c = np.bincount(np.searchsorted(inner, cur, side="right"), minlength=len(inner) + 1) / len(cur) + 1e-6
    return float(((c - r) * np.log(c / r)).sum())


@pytest.mark.parametrize("shift", [0.0, 0.3, 3.0])
def test_numeric_psi_against_numpy(spark, shift):
    rng = np.random.default_rng(1)
    ref, cur = rng.normal(size=800), rng.normal(size=500) + shift
    got = R.psi_numeric(numbers(spark, ref), numbers(spark, cur), ["x"]).first().psi
    assert got == pytest.approx(brute_psi(ref, cur), abs=1e-9)


def test_constant_reference_is_stable(spark):
    same = numbers(spark, [2.0] * 30)
    assert R.psi_numeric(same, same, ["x"]).first().psi == pytest.approx(0.0)


def test_new_category_counts_and_null_is_a_level(spark):
    ref = spark.createDataFrame([("a",)] * 50 + [(None,)] * 50, "k string")
    cur = spark.createDataFrame([("a",)] * 50 + [("new",)] * 50, "k string")
    psi = R.psi_categorical(ref, cur, ["k"]).first().psi
    expected = 2 * 0.5 * math.log((0.5 + 1e-6) / 1e-6)
    assert psi == pytest.approx(expected, rel=1e-4)
    assert R.psi_categorical(ref, ref, ["k"]).first().psi == pytest.approx(0.0)


def test_ks_against_brute_force(spark):
    rng = np.random.default_rng(3)
    ref, cur = np.round(rng.normal(size=400), 1), np.round(rng.normal(size=300) + 0.5, 1)
    row = R.ks_two_sample(numbers(spark, ref), numbers(spark, cur), ["x"]).first()
    grid = np.unique(np.concatenate([ref, cur]))
    gap = max(abs((ref <= v).mean() - (cur <= v).mean()) for v in grid)
    assert row.ks_stat == pytest.approx(gap) and row.ks_pvalue < 0.001
    same = R.ks_two_sample(numbers(spark, ref), numbers(spark, ref), ["x"]).first()
    assert same.ks_stat == 0.0 and same.ks_pvalue == 1.0


def test_report_and_summary(hotel):
    with_id = hotel.withColumn("id", F.md5(F.to_json(F.struct("*"))))
    columns = ["lead_time", "adr", "market_segment", "is_repeated_guest"]
    calm = R.summarize(R.detect_drift(with_id, with_id, "is_canceled", columns)).first()
    assert calm.overall_drift == "no_drift" and calm.max_psi == 0.0
    drifted = R.inject_drift(with_id, "id", "lead_time", "market_segment", "Groups")
    report = R.detect_drift(with_id, drifted, "is_canceled", columns)
    rows = {r.feature: r for r in report.collect()}
    assert rows["lead_time"].drift == "significant_drift" and rows["adr"].psi == 0.0
    assert rows["market_segment"].type == "categorical" and rows["market_segment"].ks_stat is None
    loud = R.summarize(report).first()
    assert loud.overall_drift == "significant_drift" and loud.top_drifted[0] == "lead_time"


def test_few_valued_numerics_are_compared_by_value(spark):
    ref = spark.createDataFrame([(0,)] * 95 + [(1,)] * 5, "flag int")
    cur = spark.createDataFrame([(0,)] * 40 + [(1,)] * 60, "flag int")
    by_level = R.detect_drift(ref, cur, "y").first()
    by_bins = R.detect_drift(ref, cur, "y", discrete_as_levels=False).first()
    assert by_level.drift == "significant_drift" and by_bins.psi == 0.0


@pytest.mark.parametrize(
    "ap,n,drift,retrain,words",
    [
        (0.50, 500, "no_drift", False, ["precision_kept"]),
        (0.30, 500, "no_drift", True, ["precision_floor"]),
        (0.42, 500, "no_drift", True, ["precision_fall"]),
        (0.30, 50, "no_drift", False, ["too_few_labels"]),
        (0.50, 500, "significant_drift", True, ["precision_kept", "inputs_shifted"]),
        (0.50, 500, "moderate_drift", False, ["precision_kept", "inputs_moving"]),
        (None, 500, "no_drift", False, []),
    ],
)
def test_policy(spark, ap, n, drift, retrain, words):
    df = spark.createDataFrame([(ap, n, drift, ["lead_time"])], "pr_auc double, n_labeled bigint, overall_drift string, top_drifted array<string>")
    row = M.retraining_decision(df, 0.49).first()
    assert row.retrain is retrain and len(row.reasons) == len(words)
    assert all(w in r for w, r in zip(words, row.reasons, strict=True))


def test_window_metric_of_one_class_is_null(spark):
    df = spark.createDataFrame([("a", 1, 0.3), ("a", 0, 0.2), ("b", 1, 0.9)], "w string, y int, p double")
    got = {r.w: r.pr_auc for r in M.window_metric(df, "y", "p", ["w"]).collect()}
    assert got == {"a": 1.0, "b": None}
