"""Missing keys, labels, scores and features keep their rows."""

from pyspark.sql import functions as F

from stayledger.operators import demand, imbalance, metrics, ordering, pricing, selection


def test_metrics_of_the_missing_segment(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), (None, 1, 0.2), (None, 0, 0.8), (None, 1, None)]
    df = spark.createDataFrame(rows, "k string, y int, p double")
    got = {r.k for r in metrics.binary_metrics(df, "y", "p", keys=["k"]).collect()}
    assert got == {"a", None}


def test_positions_count_rows_without_a_period(spark):
    df = spark.createDataFrame([(202001, 1), (None, 2), (202002, 3)], "period int, id long")
    got = {r.id: r.position for r in ordering.row_positions(df, ["period"], "id").collect()}
    assert got == {2: 0, 1: 1, 3: 2}


def test_series_without_a_key_keeps_its_demand(spark):
    rows = [(None, 202001, 10, 0, 10), (None, 202003, 10, 0, 10)]
    schema = "seg string, period int, gross_bookings long, cancellations long, realised_demand long"
    full = demand.densify(spark.createDataFrame(rows, schema), "period", ["seg"])
    assert {r.period: r.gross_bookings for r in full.collect()} == {202001: 10, 202002: 0, 202003: 10}


def test_price_of_the_missing_segment(spark):
    forecasts = spark.createDataFrame([(None, 100.0), ("a", 50.0)], "seg string, forecast double")
    rates = spark.createDataFrame([(None, 0.2), ("a", 0.1)], "seg string, base_cancel double")
    got = pricing.price_for_period(forecasts, rates, ["seg"], F.lit(110.0), F.lit(-1.2))
    assert {r.seg for r in got.select("seg").collect()} == {None, "a"}


def test_unscored_rows_are_in_no_cell(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None)], "y int, p double")
    cells = metrics.threshold_counts(df, "y", "p", [0.5]).first()
    assert (cells.tp, cells.fp, cells.fn, cells.tn) == (1, 0, 0, 1)


def test_rankings_keep_rows_with_a_missing_feature(spark):
    rows = [(i % 2, float(i), None if i % 3 else 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "y int, a double, b double")
    assert selection._assemble(df, ["a", "b"], "y").count() == 40


def test_a_missing_label_is_no_class(spark):
    rows = [(i, int(i < 10), float(i), i % 7 / 7) for i in range(40)] + [(99, None, 1.0, 0.5)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    out = imbalance.oversample_minority(df, "y", "id", ["a", "b"])
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts[1] == counts[0] == 30 and counts[None] == 1
