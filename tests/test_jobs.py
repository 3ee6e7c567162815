import pytest
from pyspark.sql import functions as F

from stayledger.operators import models
from stayledger.operators.split import plan_time_folds
from stayledger.plans import jobs
from stayledger.plans.scorer import BookingScorer, fit_scorer, prepare_tables
from stayledger.schema import Roles

ROLES = Roles()


def small(**params):
    return models.boosted(**({"maxIter": 4, "maxDepth": 3} | params))


@pytest.fixture(scope="module")
def sides(hotel):
    return jobs.prepare(hotel, ROLES)


@pytest.fixture(scope="module")
def tables(sides):
    return prepare_tables(*sides, ROLES)


@pytest.fixture(scope="module")
def scorer(tables):
    return fit_scorer(tables, ROLES, small)


def test_prepared_tables_hold_no_leak(sides, tables):
    train, test = sides
    assert "reservation_status" not in train.columns
    assert train.agg(F.max("period")).first()[0] < test.agg(F.min("period")).first()[0]
    assert train.where("country is null").count() == 0
    assert tables.train.count() == train.count()
    assert not {"is_canceled", "booking_id", "period"} & set(tables.features)


def test_scorer_learns_and_survives_a_round_trip(spark, sides, scorer, tmp_path):
    _, test = sides
    keep = (ROLES.id, ROLES.target)
    scored = scorer.transform(test, keep)
    auc = models.binary_metrics(scored, ROLES.target, "p").first().roc_auc
    assert scored.count() == test.count() and auc > 0.6
    path = str(tmp_path / "scorer")
    scorer.save(path)
    again = BookingScorer.load(spark, path).transform(test, keep)
    a = {r[0]: r.p for r in scored.collect()}
    b = {r[0]: r.p for r in again.collect()}
    assert a == pytest.approx(b)


def test_degraded_bookings_are_still_scored(sides, scorer):
    _, test = sides
    odd = test.limit(20).withColumns(
        {"country": F.lit("Nowhere"), "market_segment": F.lit("New"), "hotel": F.lit(None).cast("string")}
    )
    scored = scorer.transform(odd, (ROLES.id,))
    assert scored.where("p between 0 and 1").count() == 20
    known = set(scorer.features)
    assert not {c for c in scorer.feature_rows(odd).columns if c not in known}


def test_score_job_gives_records(sides, scorer):
    _, test = sides
    rows = jobs.score_job(scorer, test)
    assert rows.columns == ["booking_id", "probability", "prediction", "risk_band", "true_label"]
    assert rows.where("true_label is null").count() == 0
    blind = jobs.score_job(scorer, test.drop(ROLES.target))
    assert blind.where("true_label is not null").count() == 0


def test_train_job_records_the_run(spark, sides, tmp_path):
    train, test = sides
    table = str(tmp_path / "runs")

    def draw(rng):
        return {"maxIter": rng.randint(2, 3), "maxDepth": 2}

    scorer, results = jobs.train_job(train, test, ROLES, trials=2, folds=2, run_table=table, draw=draw)
    assert results["test/default/roc_auc"] > 0.55 and 0 < results["baseline/prior/pr_auc"] < 1
    assert scorer.operating.threshold == results["threshold"]
    logged = {r.name for r in spark.read.parquet(table).where("kind = 'metric'").collect()}
    assert {"test/operating/pr_auc", "baseline/logistic/pr_auc", "search/pr_auc", "threshold"} <= logged


def test_a_loaded_scorer_is_evaluated_and_explained_without_a_fit(spark, sides, tables, tmp_path, monkeypatch):
    """Evaluation and explanation of the saved state equal those of the fitted one."""
    _, test = sides
    plan = plan_time_folds(tables.train, "period", ROLES.id, "expanding", 3)
    fitted = fit_scorer(tables, ROLES, small, plan)
    path = str(tmp_path / "scorer")
    fitted.save(path)
    loaded = BookingScorer.load(spark, path)
    assert loaded.operating.threshold == fitted.operating.threshold and loaded.centers == fitted.centers

    from pyspark.ml import Estimator

    def refuse(*args, **kwargs):
        raise AssertionError("evaluation must not fit")

    monkeypatch.setattr(Estimator, "fit", refuse)
    a, b = jobs.evaluation_job(fitted, test), jobs.evaluation_job(loaded, test)
    for part in ("metrics", "metrics_operating", "summary_before", "summary_after"):
        assert a[part].first().asDict() == pytest.approx(b[part].first().asDict(), nan_ok=True)
    after = b["summary_after"].first()
    assert 0 <= after.ece <= 1 and b["cost"].where("is_best").count() == 1
    assert b["roc"].count() <= 100 and b["pr"].count() <= 100

    explained = jobs.explanation_job(loaded, test)
    assert explained["rows"].count() == test.count() and explained["signed"].count() == 10
    scores = {r[0]: r.p for r in loaded.transform(test, (ROLES.id,)).collect()}
    high, low = (explained["examples"].where(F.col("which") == w).first() for w in ("high", "low"))
    assert scores[high[ROLES.id]] == pytest.approx(max(scores.values()))
    assert scores[low[ROLES.id]] == pytest.approx(min(scores.values()))
    assert len(high.top) == 6 and abs(high.top[0].contribution) >= abs(high.top[5].contribution)
    with pytest.raises(ValueError):
        jobs.evaluation_job(BookingScorer(**{**loaded.__dict__, "operating": None}), test)


def test_selection(tables):
    rankings, consensus = jobs.selection_job(tables, ROLES, keep=45, trees=2)
    best = [r.feature for r in consensus.limit(12).collect()]
    assert set(rankings) == {"mutual_info", "anova_f", "l1", "tree", "rfe"}
    assert any(f.startswith(("lead_", "deposit_type", "risk_score")) for f in best)


def test_monitoring_holds_and_fires(sides, scorer):
    train, _ = sides
    features = ["lead_time", "adr", "market_segment", "deposit_type"]
    calm = jobs.window_for_trial(train, ROLES.id, 0.5, 1, False, ROLES)
    action, decision = jobs.monitoring_job(scorer, train, calm, 0.3, features)
    assert action == "held" and decision.first().overall_drift == "no_drift"
    moved = jobs.window_for_trial(train, ROLES.id, 0.5, 1, True, ROLES)
    action, decision = jobs.monitoring_job(scorer, train, moved, 0.3, features)
    assert action == "retraining_triggered"
    assert any("lead_time" in r for r in decision.first().reasons)
    with pytest.raises(ValueError):
        jobs.monitoring_job(scorer, train, calm.limit(0), 0.3, features)


def test_pricing_job(sides, scorer):
    train, test = sides

    def linear(label):
        from pyspark.ml.regression import LinearRegression

        return LinearRegression(featuresCol="features", labelCol=label, regParam=0.1)

    priced = jobs.pricing_job(train.unionByName(test), scorer, make_regressor=linear).collect()
    assert len(priced) == 1 and 66.0 <= priced[0].recommended_price <= 198.0


def test_stream_and_table_are_scored_alike(spark, sides, scorer, tmp_path):
    """The scorer runs unchanged on a stream of several micro-batches."""
    from stayledger.streaming import jobs as J
    from stayledger.streaming.events import read_stream

    _, test = sides
    path = str(tmp_path / "incoming")
    test.repartition(3).write.parquet(path)
    stream = read_stream(spark, path, test.schema, files_per_trigger=1)
    live = J.run_to_table(scorer.transform(stream, (ROLES.id,)), "live-scores")
    batch = scorer.transform(test, (ROLES.id,))
    a = {r[0]: r.p for r in live.collect()}
    assert len(a) == test.count()
    assert a == pytest.approx({r[0]: r.p for r in batch.collect()})


def test_rules_hold_on_a_stream(spark, hotel, tmp_path):
    from stayledger.operators.cleaning import fill_with_flag
    from stayledger.operators.quality import booking_request_rules, valid_and_quarantined
    from stayledger.streaming import jobs as J
    from stayledger.streaming.events import read_stream

    ready = fill_with_flag(hotel, ["agent", "company"])
    path = str(tmp_path / "requests")
    ready.write.parquet(path)
    good, bad = valid_and_quarantined(read_stream(spark, path, ready.schema), booking_request_rules())
    n_good = J.run_to_table(good, "valid").count()
    aside = J.run_to_table(bad, "quarantine")
    assert n_good + aside.count() == ready.count()
    assert aside.where(F.size("reasons") == 0).count() == 0 and aside.count() > 0
