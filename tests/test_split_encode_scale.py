import math

import pytest
from pyspark.sql import functions as F

from stayledger.operators import encode as E
from stayledger.operators import scale as S
from stayledger.operators import split as T
from stayledger.operators.features import engineer
from stayledger.schema import Roles


@pytest.fixture
def timeline(spark):
    rows = [(2015, "January"), (2015, "June"), (2016, "March"), (2016, "August"), (2017, "May"), (2017, "December")]
    df = spark.createDataFrame([(*r, i % 2) for i, r in enumerate(rows)], "arrival_date_year int, arrival_date_month string, is_canceled int")
    return T.with_period(df)


def test_arrival_index(timeline):
    assert [r.period for r in timeline.collect()] == [201501, 201506, 201603, 201608, 201705, 201712]


def test_time_split_toy(timeline):
    train, test, cut = T.time_split(timeline, test_size=0.34)
    assert math.isclose(cut.cutoff, 201637.1)
    assert (train.count(), test.count()) == (4, 2) == (cut.n_train, cut.n_test)
    assert train.agg(F.max("period")).first()[0] < test.agg(F.min("period")).first()[0]


def test_time_split_refuses_empty_side(spark):
    one_period = spark.createDataFrame([(201501,)] * 5, "period int")
    with pytest.raises(ValueError):
        T.time_split(one_period)
    with pytest.raises(ValueError):
        T.time_split(one_period.limit(0))


def test_boundary_period_stays_whole(spark):
    df = spark.createDataFrame([(201501,)] * 70 + [(201502,)] * 25 + [(201503,)] * 5, "period int")
    train, test, _ = T.time_split(df)
    assert train.where("period = 201502").count() == 25 and test.count() == 5


@pytest.fixture
def classes(spark):
    return spark.range(1003).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))


@pytest.mark.parametrize("limit", [20, 10**6])
def test_stratified_split_keeps_class_ratio(classes, limit):
    out = T.stratified_split(classes, "y", "id", 0.2, limit=limit)
    counts = {(r.y, r.split): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert counts[(1, "test")] == 50 and counts[(0, "test")] == 150
    assert sum(counts.values()) == 1003


@pytest.mark.parametrize("limit", [20, 10**6])
def test_stratified_folds_are_even(classes, limit):
    out = T.stratified_folds(classes, "y", "id", 5, limit=limit)
    counts = {(r.y, r.fold): r["count"] for r in out.groupBy("y", "fold").count().collect()}
    for y in (0, 1):
        sizes = [counts[(y, f)] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_folds_do_not_depend_on_partitioning(classes):
    a = T.stratified_folds(classes, "y", "id", 3)
    b = T.stratified_folds(classes.repartition(9), "y", "id", 3)
    assert a.exceptAll(b).count() == 0


def test_expanding_sizes():
    folds = T.expanding_folds(200, 5)
    assert [f.valid_from for f in folds] == [35, 68, 101, 134, 167]
    assert all(f.valid_to - f.valid_from == 33 and f.train_from == 0 for f in folds)


def test_rolling_sizes():
    folds = T.rolling_folds(300, 5)
    assert [f.valid_from - f.train_from for f in folds] == [50, 100, 100, 100, 100]
    assert folds[-1].valid_to == 300


@pytest.mark.parametrize("scheme", ["expanding", "rolling"])
@pytest.mark.parametrize("limit", [10, 10**6])
def test_time_folds_never_train_on_the_future(spark, scheme, limit):
    """One period holds a third of all rows; the order inside it is by id."""
    df = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, 201505).otherwise(201501 + F.col("id") % 9).cast("int").alias("period"), (F.col("id") % 2).cast("int").alias("y")).repartition(4)
    plan = T.plan_time_folds(df, "period", "id", scheme, 5, limit=limit)
    order = [(r.period, r.id) for r in df.orderBy("period", "id").collect()]
    for fold in plan.folds:
        train = [(r.period, r.id) for r in plan.train(df, fold).collect()]
        valid = [(r.period, r.id) for r in plan.valid(df, fold).collect()]
        assert sorted(train) == order[fold.train_from : fold.valid_from]
        assert sorted(valid) == order[fold.valid_from : fold.valid_to]
    sizes = T.describe_folds(df, plan, "y").collect()
    assert len(sizes) == 10 and all(0 <= r.positive_rate <= 1 for r in sizes)


def test_unknown_scheme_is_refused(spark):
    with pytest.raises(ValueError):
        T.plan_time_folds(spark.range(10).select("id", F.lit(201501).alias("period")), "period", "id", "random")


# --- encoders


@pytest.fixture
def coded(spark):
    rows = [(i, "A" if i < 40 else "B" if i < 58 else None if i < 59 else "C", int(i % 3 == 0)) for i in range(60)]
    return spark.createDataFrame(rows, "id bigint, country string, is_canceled int")


def test_frequency_and_unseen(spark, coded):
    state = E.fit_frequency(coded, ["country"])
    test = spark.createDataFrame([("A",), (None,), ("Z",)], "country string")
    out = E.apply_levels(test, state, ["country"], "_freq", 0.0)
    assert [r.country_freq for r in out.collect()] == pytest.approx([40 / 60, 1 / 60, 0.0])


def test_target_mean_smoothing(spark, coded):
    state, prior = E.fit_target_means(coded, ["country"], "is_canceled", m=20.0)
    got = {r.level: r.value for r in state.collect()}
    assert prior == pytest.approx(20 / 60)
    assert got["A"] == pytest.approx((14 + 20 * prior) / 60)
    assert abs(got["C"] - prior) < 0.05
    out = E.apply_levels(spark.createDataFrame([("Z",)], "country string"), state, ["country"], "_te", prior)
    assert out.first().country_te == pytest.approx(prior)


def test_no_smoothing_gives_plain_means(coded):
    state, _ = E.fit_target_means(coded, ["country"], "is_canceled", m=0.0)
    assert {r.level: r.value for r in state.collect()}["C"] == 0.0


def brute_force_oof(rows, k, m):
    out = {}
    for i, level, y, fold in rows:
        others = [r for r in rows if r[3] != fold]
        prior = sum(r[2] for r in others) / len(others)
        mine = [r[2] for r in others if r[1] == level]
        out[i] = (sum(mine) + m * prior) / (len(mine) + m) if mine else prior
    return out


def test_out_of_fold_against_brute_force(coded):
    folded = T.stratified_folds(coded, "is_canceled", "id", 5)
    state = E.fit_target_means_out_of_fold(folded, ["country"], "is_canceled", k=5, m=20.0)
    out = E.apply_levels(folded, state, ["country"], "_te", None, also_on=["fold"]).collect()
    expected = brute_force_oof([(r.id, r.country, r.is_canceled, r.fold) for r in out], 5, 20.0)
    assert {r.id: r.country_te for r in out} == pytest.approx(expected)


def test_own_label_never_reaches_own_code(coded):
    folded = T.stratified_folds(coded, "is_canceled", "id", 5)

    def code(df):
        state = E.fit_target_means_out_of_fold(df, ["country"], "is_canceled", k=5)
        out = E.apply_levels(df, state, ["country"], "_te", None, also_on=["fold"])
        return out.where("id = 7").first().country_te

    flip = F.when(F.col("id") == 7, 1 - F.col("is_canceled")).otherwise(F.col("is_canceled"))
    assert code(folded) == code(folded.withColumn("is_canceled", flip))


def test_absent_level_takes_the_chosen_prior(coded):
    folded = T.stratified_folds(coded, "is_canceled", "id", 5)
    single = [r.fold for r in folded.where("country is null").collect()][0]
    for absent in ("fold_prior", "global_prior"):
        state = E.fit_target_means_out_of_fold(folded, ["country"], "is_canceled", k=5, absent=absent)
        value = state.where((F.col("level") == "__null__") & (F.col("fold") == single)).first().value
        rows = folded if absent == "global_prior" else folded.where(F.col("fold") != single)
        assert value == pytest.approx(rows.agg(F.avg("is_canceled")).first()[0])


def test_one_hot_follows_train(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    test = spark.createDataFrame([("b",), ("c",), (None,)], "k string")
    levels = E.train_levels(train, ["k"])
    out = E.one_hot(test, levels)
    assert out.columns == ["k_a", "k_b"]
    assert [tuple(r) for r in out.collect()] == [(0, 1), (0, 0), (0, 0)]
    dotted = spark.createDataFrame([("St. A",), ("x",)], "k string")
    assert E.one_hot(dotted, E.train_levels(dotted, ["k"])).columns == ["k_St_ A", "k_x"]
    with pytest.raises(ValueError):
        E.train_levels(spark.range(50).select(F.col("id").cast("string").alias("k")), ["k"], max_levels=10)


def test_encoded_tables_are_numeric_and_aligned(hotel):
    from stayledger.operators.quality import require_model_ready
    from stayledger.plans.jobs import prepare

    roles = Roles()
    train, test = prepare(hotel, roles)
    train_e, test_e, state = E.encode_train_test(engineer(train, roles), engineer(test, roles), roles)
    train_x, test_x = train_e.drop(roles.id), test_e.drop(roles.id)
    require_model_ready(train_x, test_x)
    assert train_e.count() == train.count() and test_e.count() == test.count()
    assert not set(roles.high_card) & set(train_e.columns)


# --- scalers


def test_binary_detection(spark):
    df = spark.createDataFrame([(0, 1.0, None, 3, 0.0), (1, 0.0, None, 4, 0.5)], "a int, b double, c int, d int, e double")
    got = {r.feature: r.is_binary for r in S.binary_flags_per_column(df, df.columns).collect()}
    assert got == {"a": True, "b": True, "c": True, "d": False, "e": False}


def test_robust_values(spark):
    df = spark.createDataFrame([(float(v), 7.0) for v in (1, 2, 3, 4, 6, 10)], "x double, same double")
    state = S.fit_scaler(df, ["x", "same"], "robust")
    assert (state.center["x"], state.scale["x"]) == (3.5, 3.25)
    assert state.scale["same"] == 1.0
    assert {r.same for r in state.apply(df).collect()} == {0.0}


def test_standard_uses_population_spread(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert [r.x for r in S.fit_scaler(df, ["x"], "standard").apply(df).collect()] == [-1.0, 1.0]


def test_minmax_and_unknown_kind(spark):
    df = spark.createDataFrame([(2.0,), (4.0,), (3.0,)], "x double")
    assert [r.x for r in S.fit_scaler(df, ["x"], "minmax").apply(df).collect()] == [0.0, 1.0, 0.5]
    with pytest.raises(ValueError):
        S.fit_scaler(df, ["x"], "quantum")


def test_scaler_ignores_test_rows(spark):
    train = spark.range(100).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    test_a = train.withColumn("x", F.col("x") * 1000)
    _, _, a = S.scale_train_test(train, train, "y")
    _, scaled, b = S.scale_train_test(train, test_a, "y")
    assert a == b and a.columns == ("x",)
    assert scaled.agg(F.max("x")).first()[0] > 100


def test_rows_without_a_period_are_counted(spark):
    df = spark.createDataFrame([(201501,), (201502,), (201503,), (None,), (None,)], "period int")
    with pytest.warns(UserWarning, match="2 rows have no period"):
        train, test, cut = T.time_split(df)
    assert (cut.n_train, cut.n_test, cut.n_undated) == (train.count(), test.count(), 2)
