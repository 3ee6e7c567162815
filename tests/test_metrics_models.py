import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.operators import explain as X
from stayledger.operators import imbalance as I
from stayledger.operators import metrics as M
from stayledger.operators import models as O
from stayledger.operators import selection as S
from stayledger.operators.isotonic import calibrate, fit_isotonic
from stayledger.operators.split import plan_time_folds


def frame(spark, y, p):
    return spark.createDataFrame(list(zip(y, p, strict=True)), "y int, p double")


def brute_auc(y, p):
    pos = [b for a, b in zip(y, p, strict=True) if a]
    neg = [b for a, b in zip(y, p, strict=True) if not a]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)


def brute_ap(y, p):
    total, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = [a for a, b in zip(y, p, strict=True) if b >= t]
        recall = sum(hit) / sum(y)
        total += (recall - last) * sum(hit) / len(hit)
        last = recall
    return total


def test_hand_values(spark):
    row = M.binary_metrics(frame(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8]), "y", "p").first()
    assert row.roc_auc == pytest.approx(0.75) and row.pr_auc == pytest.approx(0.8333, abs=1e-4)
    assert (row.precision, row.recall) == (1.0, 0.5) and row.f1 == pytest.approx(2 / 3)
    assert row.brier == pytest.approx(np.mean([0.01, 0.16, 0.4225, 0.04]))


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_rank_metrics_with_ties(spark, digits):
    rng = random.Random(digits)
    p = [round(rng.random(), digits) for _ in range(400)]
    y = [int(rng.random() < v * 0.7) for v in p]
    row = M.binary_metrics(frame(spark, y, p).repartition(5), "y", "p").first()
    assert row.roc_auc == pytest.approx(brute_auc(y, p))
    assert row.pr_auc == pytest.approx(brute_ap(y, p))


def test_one_class_and_empty(spark):
    row = M.binary_metrics(frame(spark, [0, 0], [0.2, 0.9]), "y", "p").first()
    assert row.roc_auc is None and row.pr_auc is None and row.f1 == 0.0
    assert M.binary_metrics(frame(spark, [0], [0.1]).limit(0), "y", "p", keys=["y"]).count() == 0


def test_thresholds_and_costs(spark):
    rng = random.Random(1)
    p = [round(rng.random(), 2) for _ in range(300)]
    y = [int(rng.random() < v) for v in p]
    df = frame(spark, y, p)
    got = {r.threshold: r for r in M.threshold_counts(df, "y", "p").collect()}
    assert len(got) == 19
    for t, r in got.items():
        assert r.tp == sum(1 for a, b in zip(y, p, strict=True) if a and b >= t)
        assert r.fn == sum(1 for a, b in zip(y, p, strict=True) if a and b < t)
        assert r.tp + r.fp + r.fn + r.tn == 300
    costs = M.cost_curve(df, "y", "p", 5, 1).collect()
    best = min(costs, key=lambda r: (r.cost, r.threshold))
    assert [r.threshold for r in costs if r.is_best] == [best.threshold]


def test_costlier_misses_lower_the_threshold(spark):
    rng = random.Random(2)
    p = [rng.random() for _ in range(500)]
    df = frame(spark, [int(rng.random() < v) for v in p], p)
    at = [M.cost_curve(df, "y", "p", fn, 1).where("is_best").first().threshold for fn in (1, 10)]
    assert at[1] < at[0]


def test_roc_points_match_brute_force(spark):
    rng = random.Random(3)
    p = [round(rng.random(), 2) for _ in range(500)]
    y = [int(rng.random() < v) for v in p]
    rows = sorted(M.roc_points(frame(spark, y, p), "y", "p").collect(), key=lambda r: r.point)
    assert len(rows) <= 100 and (rows[0].fpr, rows[0].tpr) == (0.0, 0.0)
    assert (rows[-1].fpr, rows[-1].tpr) == (1.0, 1.0)
    assert all(r.auc == pytest.approx(brute_auc(y, p)) for r in rows)
    assert all(a.fpr <= b.fpr and a.tpr <= b.tpr for a, b in zip(rows, rows[1:], strict=False))


def test_straight_stretches_are_left_out(spark):
    """Distinct scores, perfect ranking: only the corner points of the curve stay."""
    y = [0] * 50 + [1] * 50
    rows = M.roc_points(frame(spark, y, [i / 100 for i in range(100)]), "y", "p").collect()
    assert len(rows) <= 5 and rows[0].auc == 1.0


def test_pr_points_baseline_and_ends(spark):
    rows = sorted(M.pr_points(frame(spark, [0, 0, 0, 1], [0.1, 0.2, 0.3, 0.9]), "y", "p").collect(), key=lambda r: r.point)
    assert all(r.baseline == 0.25 for r in rows)
    assert (rows[0].precision, rows[0].recall) == (0.25, 1.0)
    assert (rows[-1].precision, rows[-1].recall) == (1.0, 0.0)


def test_calibration_sees_overconfidence(spark):
    rng = random.Random(4)
    q = [rng.random() for _ in range(3000)]
    y = [int(rng.random() < v) for v in q]
    honest = M.calibration_summary(M.calibration_bins(frame(spark, y, q), "y", "p")).first()
    pushed = [min(1.0, max(0.0, 0.5 + 2 * (v - 0.5))) for v in q]
    loud = M.calibration_summary(M.calibration_bins(frame(spark, y, pushed), "y", "p")).first()
    assert honest.ece < 0.05 < loud.ece

    half = frame(spark, y[:1500], pushed[:1500])
    rest = frame(spark, y[1500:], pushed[1500:])
    fixed = calibrate(fit_isotonic(half, "y", "p"), rest, "p")
    after = M.calibration_summary(M.calibration_bins(fixed, "y", "p_calibrated")).first()
    before = M.calibration_summary(M.calibration_bins(rest, "y", "p")).first()
    assert after.brier < before.brier
    rows = fixed.orderBy("p").collect()
    values = [r.p_calibrated for r in rows]
    assert all(a <= b + 1e-12 for a, b in zip(values, values[1:], strict=False))


# --- feature ranking and explanations


@pytest.fixture(scope="module")
def signal(spark):
    rng = random.Random(7)
    rows = []
    for i in range(500):
        strong, noise, tiny = rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)
        y = int(rng.random() < 1 / (1 + math.exp(-(2.5 * strong - 0.5))))
        rows.append((i, 201501 + i // 50, y, strong, noise, tiny, float(rng.random() < 0.5)))
    return spark.createDataFrame(rows, "id bigint, period int, is_canceled int, strong double, noise double, tiny double, coin double").cache()


FEATURES = ["strong", "noise", "tiny", "coin"]


def first(df):
    return df.orderBy(F.desc("score")).first().feature


def test_every_method_finds_the_signal(signal):
    rankings = {
        "mutual_info": S.mutual_info_binned(signal, FEATURES, "is_canceled"),
        "anova_f": S.anova_f(signal, FEATURES, "is_canceled"),
        "l1": S.l1_scores(signal, FEATURES, "is_canceled"),
        "tree": S.tree_gain_scores(signal, FEATURES, "is_canceled", trees=5, depth=3),
        "rfe": S.rfe_ranks(signal, FEATURES, "is_canceled", keep=1),
    }
    for name, r in rankings.items():
        best = r.orderBy("score" if name == "rfe" else F.desc("score")).first()
        assert best.feature == "strong", name
    assert sorted(r.score for r in rankings["rfe"].collect()) == [1, 2, 3, 4]
    consensus = S.consensus_ranking(rankings).collect()
    assert consensus[0].feature == "strong" and consensus[0].mean_rank == 1.0


def test_ties_share_the_average_rank(spark):
    scores = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 0.5)], "feature string, score double")
    got = {r.feature: r.mean_rank for r in S.consensus_ranking({"m": scores}).collect()}
    assert got == {"a": 1.5, "b": 1.5, "c": 3.0}


def test_anova_against_numpy(signal):
    pdf = signal.toPandas()
    groups = [g["strong"].to_numpy() for _, g in pdf.groupby("is_canceled")]
    grand = pdf["strong"].mean()
    between = sum(len(g) * (g.mean() - grand) ** 2 for g in groups) / (len(groups) - 1)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(pdf) - len(groups))
    got = {r.feature: r.score for r in S.anova_f(signal, FEATURES, "is_canceled").collect()}
    assert got["strong"] == pytest.approx(between / within)


def test_constant_feature_has_no_score(signal):
    flat = signal.withColumn("flat", F.lit(1.0))
    assert {r.feature: r.score for r in S.anova_f(flat, ["flat"], "is_canceled").collect()} == {"flat": None}
    assert S.mutual_info_binned(flat, ["flat"], "is_canceled").first().score == pytest.approx(0.0)


def test_contributions_add_up(signal):
    coefs = {"strong": 2.0, "noise": -0.1}
    means = X.train_means(signal, list(coefs))
    base = X.base_value(coefs, -0.5, means)
    rows = X.contributions(signal, coefs, means)
    local = X.local_explanations(rows, "id", list(coefs), base).collect()
    truth = {r.id: -0.5 + 2.0 * r.strong - 0.1 * r.noise for r in signal.collect()}
    assert all(r.prediction_logit == pytest.approx(truth[r.id]) for r in local)
    assert X.global_importance(rows, list(coefs)).first().feature == "strong"
    effects = {r.feature: r.direction for r in X.signed_effect(rows, list(coefs)).collect()}
    assert effects == {"strong": "up", "noise": "down"}
    extremes = X.extreme_rows(X.local_explanations(rows, "id", list(coefs), base), "id").collect()
    assert {r.which: r.id for r in extremes} == {"high": max(truth, key=truth.get), "low": min(truth, key=truth.get)}


# --- models


def quick():
    return O.boosted(maxIter=5, maxDepth=3)


def test_model_beats_prior_and_search_is_seeded(signal):
    plan = plan_time_folds(signal, "period", "id", "expanding", 3)
    base = O.run_baselines(signal, plan, FEATURES, "is_canceled")
    value = {name: v for name, _, v in base}
    assert value["logistic"] > value["prior"] + 0.2

    def draw(rng):
        return {"maxIter": rng.randint(2, 4), "maxDepth": rng.randint(2, 3)}

    tried = [O.search(signal, plan, FEATURES, "is_canceled", 3, draw=draw).collect() for _ in range(2)]
    assert tried[0] == tried[1] and tried[0][0].pr_auc >= tried[0][-1].pr_auc
    assert O.typed_params({"a": "3", "b": "0.5", "featureSubsetStrategy": "0.7"}) == {"a": 3, "b": 0.5, "featureSubsetStrategy": "0.7"}


def test_final_fit_and_permutation(signal):
    train, test = signal.where("period < 201508"), signal.where("period >= 201508")
    plan = plan_time_folds(train, "period", "id", "expanding", 3)
    fitted = O.fit_final(train, test, plan, FEATURES, "is_canceled", quick)
    measured = {(kind, name): v for kind, _, name, v in fitted.measured}
    assert measured["default", "roc_auc"] == measured["operating", "roc_auc"] > 0.8
    assert 0.05 <= fitted.operating.threshold <= 0.95
    loss = O.permutation_importance(fitted.model, test, "id", FEATURES, "is_canceled", shuffle=["strong", "noise"]).collect()
    assert loss[0].feature == "strong" and loss[0].ap_loss > 0.1


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 80 + [(1,)] * 20, "y int")
    got = {r.y: r.weight for r in I.class_weights(df, "y").collect()}
    assert got == {0: 0.625, 1: 2.5}
    assert I.pos_weight(df, "y").first()[0] == 4.0
    assert I.with_class_weight(df, "y").agg(F.sum("weight")).first()[0] == pytest.approx(100.0)
    assert I.pos_weight(df.where("y = 0"), "y").first()[0] is None


@pytest.fixture(scope="module")
def lopsided(spark):
    rng = random.Random(9)
    rows = [(i, int(i % 5 == 0), *[rng.gauss(2.0 * (i % 5 == 0), 1) for _ in range(4)]) for i in range(200)]
    return spark.createDataFrame(rows, "id bigint, y int, a double, b double, c double, d double")


def test_oversampling_reaches_parity_inside_the_hull(lopsided):
    cols = ["a", "b", "c", "d"]
    out = I.oversample_minority(lopsided, "y", "id", cols)
    assert {r.y: r["count"] for r in out.groupBy("y").count().collect()} == {0: 160, 1: 160}
    assert lopsided.select("y", *cols).exceptAll(out).count() == 0
    minority = np.array([[r[c] for c in cols] for r in lopsided.where("y = 1").collect()])
    made = np.array([[r[c] for c in cols] for r in out.where("y = 1").collect()])
    assert (made >= minority.min(axis=0) - 1e-9).all() and (made <= minority.max(axis=0) + 1e-9).all()
    for x in made:  # every row lies on a segment between two minority rows
        d = np.linalg.norm(minority - x, axis=1)
        gaps = np.linalg.norm(minority[:, None] - minority[None], axis=2)
        assert (np.abs(d[:, None] + d[None] - gaps) < 1e-6).any()


def test_neighbours_are_near(lopsided):
    cols = ["a", "b", "c", "d"]
    rows = lopsided.where("y = 0")
    points = {r.id: np.array([r[c] for c in cols]) for r in rows.collect()}
    near = I.near_neighbours(rows, "id", cols).collect()
    assert len(near) == 160
    found, best = [], []
    for r in near:
        assert len(r.near) == 5 and all(n.id != r.id for n in r.near)
        found.append(np.mean([n.d for n in r.near]))
        every = sorted(((points[r.id] - v) ** 2).sum() for k, v in points.items() if k != r.id)
        best.append(np.mean(every[:5]))
    assert np.mean(found) < 2.5 * np.mean(best)


def test_coinciding_rows_are_no_problem(spark):
    rows = [(i, int(i >= 100), 1.0 if i >= 120 else i / 10, 2.0) for i in range(150)]
    df = spark.createDataFrame(rows, "id bigint, y int, a double, b double")
    out = I.oversample_minority(df, "y", "id", ["a", "b"])
    assert out.where("y = 1").count() == 100


def test_resampling_before_the_folds_flatters(lopsided):
    noisy = lopsided.select("id", "y", *[(F.rand(i)).alias(c) for i, c in enumerate("abcd")])
    from stayledger.session import settle

    scores = O.resampling_trap(settle(noisy), ["a", "b", "c", "d"], "y", "id", k=2, make=quick)
    assert scores["wrong"] > scores["right"]
