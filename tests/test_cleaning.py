import pytest
from pyspark.sql import functions as F

from stayledger.operators import cleaning as C
from stayledger.operators import quality as Q
from stayledger.operators.sampling import sample_fraction, sample_n
from stayledger.schema import RAW_BOOKING
from stayledger.sources.files import read_raw, read_stage, write_report, write_stage

TOY = "adr double, adults int, children int, babies int, agent double, company double, country string, reservation_status string"


@pytest.fixture
def toy(spark):
    return spark.createDataFrame(
        [
            (100.0, 2, 0, 0, 9.0, None, "PRT", "Check-Out"),
            (-5.0, 1, None, 0, None, None, None, "Canceled"),
            (50.0, 0, 0, 0, None, 40.0, "GBR", "Check-Out"),
            (50.0, 1, 1, 0, 3.0, None, "PRT", "Check-Out"),
        ],
        TOY,
    )


def test_leak_column_goes(toy):
    assert "reservation_status" not in C.drop_columns(toy, ["reservation_status", "absent"]).columns


def test_clean_repairs_values_and_flags(toy):
    out = C.clean(toy).orderBy("adr").collect()
    assert [r.adr for r in out] == [0.0, 50.0, 100.0]
    assert [r.agent_missing for r in out] == [1, 0, 0]
    assert all(r.children is not None and r.company == 0.0 for r in out)


def test_cap_and_clip_keep_null(spark):
    df = spark.createDataFrame([(5400.0,), (-1.0,), (None,), (1000.0,)], "adr double")
    out = C.cap_ceiling(C.clip_negative(df, "adr"), "adr", 1000.0)
    assert [r.adr for r in out.collect()] == [1000.0, 0.0, None, 1000.0]


def test_duplicates_with_nulls_are_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert C.drop_exact_duplicates(df).count() == 2


def test_audit_counts_every_rule(toy):
    audit = {r.rule: r.n_rows for r in C.cleaning_audit(toy).collect()}
    assert audit == {
        "rows": 4,
        "negative_price": 1,
        "price_above_ceiling": 0,
        "empty_party": 1,
        "agent_null": 2,
        "company_null": 3,
        "children_null": 1,
    }


def test_mode_comes_from_train_and_ties_go_low(spark):
    train = spark.createDataFrame([("B",), ("A",), ("B",), ("A",), (None,)], "country string")
    test = spark.createDataFrame([("Z",), ("Z",), ("Z",), (None,)], "country string")
    (train2, test2), fill = C.impute_mode(train, [test], "country", with_flag=True)
    assert fill == "A"
    assert [r.country for r in test2.where("country_missing = 1").collect()] == ["A"]
    assert train2.where("country is null").count() == 0


def test_mode_of_all_null_column_changes_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "country string")
    (out,), fill = C.impute_mode(df, [], "country")
    assert fill is None and out.where("country is null").count() == 2


def test_window_gate(spark):
    good = spark.createDataFrame([(1, 50.0), (0, -1.0)], "is_canceled int, adr double")
    assert Q.window_verdict(good, "is_canceled", "adr").first().ok
    for bad in (good.limit(0), good.drop("is_canceled"), good.withColumn("adr", F.lit(20_000.0))):
        assert not Q.window_verdict(bad, "is_canceled", "adr").first().ok
        with pytest.raises(ValueError):
            Q.require_valid_window(bad, "is_canceled", "adr")


def test_booking_contract(hotel):
    ready = C.fill_with_flag(hotel, ["agent", "company"])
    rules = Q.booking_request_rules()
    good, bad = Q.valid_and_quarantined(ready, rules)
    assert good.count() + bad.count() == ready.count()
    reasons = {r[0] for r in bad.select(F.explode("reasons")).distinct().collect()}
    assert reasons == {"adr_out_of_range", "children_out_of_range"}
    broken = ready.limit(1).withColumn("deposit_type", F.lit("Maybe")).withColumn("lead_time", F.lit(2000))
    got = set(Q.with_reject_reasons(broken, rules).first().reasons)
    assert {"deposit_type_not_allowed", "lead_time_out_of_range"} <= got


def test_defaults_fill_absent_values(spark):
    df = spark.createDataFrame([(None, None)], "country string, company_missing int")
    row = Q.with_defaults(df).first()
    assert (row.country, row.company_missing) == ("PRT", 1)


def test_align_adds_and_drops(spark):
    df = spark.createDataFrame([(1, 2)], "b int, extra int")
    out = Q.align_schema(df, ["a", "b"])
    assert out.columns == ["a", "b"] and out.first().asDict() == {"a": 0, "b": 1}


def test_model_ready_check(spark):
    num = spark.createDataFrame([(1, 2.0)], "a int, b double")
    Q.require_model_ready(num, num)
    with pytest.raises(ValueError):
        Q.require_model_ready(num, num.select("b", "a"))
    with pytest.raises(ValueError):
        Q.require_model_ready(num.withColumn("s", F.lit("x")), num)


def test_samples_are_exact_and_stable(spark):
    df = spark.range(1000)
    a, b = sample_n(df, "id", 50, 7), sample_n(df.repartition(7), "id", 50, 7)
    assert {r.id for r in a.collect()} == {r.id for r in b.collect()}
    assert sample_fraction(df, "id", 0.25, 3).count() == 250
    assert sample_fraction(df, "id", 0.0, 3).count() == 0


def test_raw_csv_round_trip(spark, hotel, tmp_path):
    path = str(tmp_path / "raw")
    write_stage(hotel, path, "csv")
    back = read_raw(spark, path)
    assert back.schema == RAW_BOOKING and back.count() == hotel.count()
    assert back.exceptAll(hotel).count() == 0


def test_nan_reads_as_null(spark, tmp_path):
    path = str(tmp_path / "nan")
    spark.createDataFrame([("1", "NaN"), ("2", "3.5")], "a string, adr string").write.csv(path, header=True)
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("adr", T.DoubleType())])
    assert {r.adr for r in read_raw(spark, path, schema=schema).collect()} == {None, 3.5}


def test_state_report_sinks(spark, toy, tmp_path):
    write_report(toy, str(tmp_path / "report"))
    assert read_stage(spark, str(tmp_path / "report"), "json", toy.schema).count() == 4
    write_stage(toy, str(tmp_path / "stage"), partition_by=("country",))
    assert read_stage(spark, str(tmp_path / "stage")).count() == 4
