"""Splits, folds, encoders and scalers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as E
from ..operators import scale as S
from ..operators import split as T
from ..operators.features import engineer
from ..operators.ordering import row_positions
from ..schema import Roles
from ..session import stage
from ..sources.tables import bookings, staged_bookings
from .queries_features import ENGINEERED, FEATURE_INPUT
from .queries_features import ROLES as FEATURE_ROLES
from .registry import BOOKINGS, SPLIT, hash_key, query, rounded, sql_over

ROLES = Roles(deposit_flag="1-URGENT", segment_flag="BUILDING")
HIGH_CARD = ("country", "agent", "company")
FOLDS = 5
M = 20.0


@query(
    "time_split",
    sql_over(
        BOOKINGS,
        SPLIT,
        select="""SELECT side, cutoff, count(*) AS n_rows, round(avg(is_canceled), 6) AS positive_rate,
          min(period) AS first_period, max(period) AS last_period
          FROM (SELECT *, CASE WHEN period <= c THEN 'train' ELSE 'test' END AS side,
                CAST(c AS DOUBLE) AS cutoff FROM bookings, cut) GROUP BY ALL""",
    ),
)
def _time_split(spark, sf):
    b = bookings(spark, sf, ["period", "is_canceled"])
    train, test, cut = T.time_split(b)
    sides = train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )
    summary = sides.groupBy("side", F.lit(cut.cutoff).alias("cutoff")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("is_canceled").alias("positive_rate"),
        F.min("period").alias("first_period"),
        F.max("period").alias("last_period"),
    )
    return rounded(summary)


@query(
    "split_no_overlap",
    sql_over(
        BOOKINGS,
        SPLIT,
        select="""SELECT (SELECT count(*) FROM (SELECT booking_id FROM train INTERSECT
            SELECT booking_id FROM test)) AS n_shared,
          (SELECT max(period) FROM train) < (SELECT min(period) FROM test) AS in_order""",
    ),
)
def _split_no_overlap(spark, sf):
    train, test, _ = T.time_split(bookings(spark, sf, ["booking_id", "period"]))
    shared = train.select("booking_id").intersect(test.select("booking_id"))
    edges = train.agg(F.max("period")).scalar() < test.agg(F.min("period")).scalar()
    return shared.agg(F.count(F.lit(1)).alias("n_shared")).withColumn("in_order", edges)


@query(
    "stratified_split",
    sql_over(
        BOOKINGS,
        select=f"""SELECT booking_id, is_canceled,
          CASE WHEN rn <= floor(0.2 * n + 0.5) THEN 'test' ELSE 'train' END AS split FROM (
          SELECT booking_id, is_canceled, count(*) OVER (PARTITION BY is_canceled) AS n,
            row_number() OVER (PARTITION BY is_canceled ORDER BY {hash_key('booking_id', 42)}) AS rn
          FROM bookings)""",
    ),
)
def _stratified_split(spark, sf):
    b = bookings(spark, sf, ["booking_id", "is_canceled"])
    return T.stratified_split(b, "is_canceled", "booking_id")


def _fold_sql(source: str) -> str:
    return f"""folded AS (SELECT * EXCLUDE (rn, cn), CAST(floor((rn - 1) * {FOLDS} / cn) AS INTEGER) AS fold FROM (
      SELECT {source}.*, count(*) OVER (PARTITION BY is_canceled) AS cn,
        row_number() OVER (PARTITION BY is_canceled ORDER BY {hash_key('booking_id', 42)}) AS rn
      FROM {source}))"""


@query(
    "stratified_kfold",
    sql_over(
        BOOKINGS, _fold_sql("bookings"), select="SELECT booking_id, is_canceled, fold FROM folded"
    ),
)
def _stratified_kfold(spark, sf):
    b = bookings(spark, sf, ["booking_id", "is_canceled"])
    return T.stratified_folds(b, "is_canceled", "booking_id", FOLDS)


@query(
    "time_order",
    """SELECT o_orderkey AS booking_id, row_number() OVER (ORDER BY
       year(o_orderdate) * 100 + month(o_orderdate), o_orderkey) - 1 AS position FROM orders""",
)
def _time_order(spark, sf):
    b = bookings(spark, sf, ["booking_id", "period"])
    return row_positions(b, ["period"], "booking_id").select("booking_id", "position")


_POSITIONS = """placed AS (SELECT booking_id, is_canceled, count(*) OVER () AS n,
  row_number() OVER (ORDER BY period, booking_id) - 1 AS pos FROM bookings),
folds AS (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS fold)"""

_EXPANDING = """roles AS (SELECT booking_id, is_canceled, fold,
  CASE WHEN pos < n - (6 - fold) * (n // 6) THEN 'train' ELSE 'valid' END AS role
  FROM placed, folds WHERE pos < n - (5 - fold) * (n // 6))"""

_ROLLING = """roles AS (SELECT booking_id, is_canceled, fold,
  CASE WHEN pos < fold * (n // 6) THEN 'train' ELSE 'valid' END AS role FROM placed, folds
  WHERE pos >= greatest(0, fold * (n // 6) - 2 * (n // 6))
    AND pos < CASE WHEN fold = 5 THEN n ELSE (fold + 1) * (n // 6) END)"""


def _folded(spark, sf, scheme):
    b = bookings(spark, sf, ["booking_id", "period", "is_canceled"])
    return b, T.plan_time_folds(b, "period", "booking_id", scheme, FOLDS)


@query(
    "cv_expanding",
    sql_over(
        BOOKINGS, _POSITIONS, _EXPANDING, select="SELECT booking_id, fold, role FROM roles"
    ),
)
def _cv_expanding(spark, sf):
    b, plan = _folded(spark, sf, "expanding")
    return T.with_folds(b, plan).select("booking_id", "fold", "role")


@query(
    "cv_rolling",
    sql_over(BOOKINGS, _POSITIONS, _ROLLING, select="SELECT booking_id, fold, role FROM roles"),
)
def _cv_rolling(spark, sf):
    b, plan = _folded(spark, sf, "rolling")
    return T.with_folds(b, plan).select("booking_id", "fold", "role")


@query(
    "cv_describe",
    sql_over(
        BOOKINGS,
        _POSITIONS,
        _EXPANDING,
        select="""SELECT fold, role, count(*) AS n_rows, round(avg(is_canceled), 6) AS positive_rate
          FROM roles GROUP BY ALL""",
    ),
)
def _cv_describe(spark, sf):
    b, plan = _folded(spark, sf, "expanding")
    return rounded(T.describe_folds(b, plan, "is_canceled"))


# --- encoders --------------------------------------------------------------------------------------

_LEVELS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), '__null__') AS level, "
    f"booking_id, is_canceled{{extra}} FROM {{source}}"
    for c in HIGH_CARD
)


def _levels(name: str, source: str, extra: str = "") -> str:
    return f"{name} AS ({_LEVELS.format(source=source, extra=extra)})"


_FREQ = """freq AS (SELECT feature, level, count(*) AS n,
  count(*) / (SELECT count(*) FROM train) AS value FROM train_levels GROUP BY ALL)"""

_TE = f"""prior AS (SELECT avg(is_canceled) AS prior FROM train),
te AS (SELECT feature, level, count(*) AS n,
  (sum(is_canceled) + {M} * any_value(prior)) / (count(*) + {M}) AS value
  FROM train_levels, prior GROUP BY ALL)"""

_OOF = f"""fold_sums AS (SELECT feature, level, fold, count(*) AS n, sum(is_canceled) AS s
  FROM folded_levels GROUP BY ALL),
level_sums AS (SELECT feature, level, sum(n) AS n, sum(s) AS s FROM fold_sums GROUP BY ALL),
fold_priors AS (SELECT fold, ((SELECT sum(is_canceled) FROM folded) - sum(is_canceled))
  / ((SELECT count(*) FROM folded) - count(*)) AS prior FROM folded GROUP BY fold),
oof AS (SELECT f.feature, f.level, f.fold, f.n,
  CASE WHEN l.n - f.n > 0 THEN (l.s - f.s + {M} * p.prior) / (l.n - f.n + {M}) ELSE p.prior END AS value
  FROM fold_sums f JOIN level_sums l USING (feature, level) JOIN fold_priors p USING (fold))"""


def _wide(values: str, source: str, suffix: str, default: str, fold: bool = False) -> str:
    """Correlated lookups of one value per high-cardinality column."""
    out = []
    for c in HIGH_CARD:
        also = f" AND v.fold = {source}.fold" if fold else ""
        out.append(
            f"coalesce((SELECT v.value FROM {values} v WHERE v.feature = '{c}' AND "
            f"v.level = coalesce(CAST({source}.{c} AS VARCHAR), '__null__'){also}), {default}) "
            f"AS {c}{suffix}"
        )
    return ", ".join(out)


def _round(names, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in names)


_ENC_INPUT = ["booking_id", "period", "is_canceled", *HIGH_CARD]


@query(
    "frequency_encode",
    sql_over(
        BOOKINGS,
        SPLIT,
        _levels("train_levels", "train"),
        _FREQ,
        f"coded AS (SELECT booking_id, {_wide('freq', 'test', '_freq', '0.0')} FROM test)",
        select=f"SELECT booking_id, {_round([c + '_freq' for c in HIGH_CARD])} FROM coded",
    ),
)
def _frequency_encode(spark, sf):
    train, test, _ = T.time_split(staged_bookings(spark, sf, _ENC_INPUT))
    state = E.fit_frequency(train, HIGH_CARD)
    coded = E.apply_levels(test, state, HIGH_CARD, "_freq", 0.0)
    return rounded(coded.drop("period", "is_canceled", *HIGH_CARD))


@query(
    "frequency_state",
    sql_over(
        BOOKINGS,
        SPLIT,
        _levels("train_levels", "train"),
        _FREQ,
        select="SELECT feature, level, n, round(value, 6) AS value FROM freq",
    ),
)
def _frequency_state(spark, sf):
    train, _, _ = T.time_split(staged_bookings(spark, sf, _ENC_INPUT))
    return rounded(E.fit_frequency(train, HIGH_CARD))


@query(
    "target_encode",
    sql_over(
        BOOKINGS,
        SPLIT,
        _levels("train_levels", "train"),
        _TE,
        select="SELECT feature, level, n, round(value, 6) AS value FROM te",
    ),
)
def _target_encode(spark, sf):
    train, _, _ = T.time_split(staged_bookings(spark, sf, _ENC_INPUT))
    return rounded(E.fit_target_means(train, HIGH_CARD, "is_canceled", M)[0])


@query(
    "target_encode_apply",
    sql_over(
        BOOKINGS,
        SPLIT,
        _levels("train_levels", "train"),
        _TE,
        f"coded AS (SELECT booking_id, {_wide('te', 'test', '_te', '(SELECT prior FROM prior)')} FROM test)",
        select=f"SELECT booking_id, {_round([c + '_te' for c in HIGH_CARD])} FROM coded",
    ),
)
def _target_encode_apply(spark, sf):
    train, test, _ = T.time_split(staged_bookings(spark, sf, _ENC_INPUT))
    state, prior = E.fit_target_means(train, HIGH_CARD, "is_canceled", M)
    coded = E.apply_levels(test, state, HIGH_CARD, "_te", prior)
    return rounded(coded.drop("period", "is_canceled", *HIGH_CARD))


@query(
    "target_encode_oof",
    sql_over(
        BOOKINGS,
        SPLIT,
        _fold_sql("train"),
        _levels("folded_levels", "folded", ", fold"),
        _OOF,
        f"coded AS (SELECT booking_id, fold, {_wide('oof', 'folded', '_te', 'NULL', fold=True)} FROM folded)",
        select=f"SELECT booking_id, fold, {_round([c + '_te' for c in HIGH_CARD])} FROM coded",
    ),
)
def _target_encode_oof(spark, sf):
    train, _, _ = T.time_split(staged_bookings(spark, sf, _ENC_INPUT))
    folded = T.stratified_folds(train, "is_canceled", "booking_id", FOLDS)
    state = E.fit_target_means_out_of_fold(folded, HIGH_CARD, "is_canceled", k=FOLDS, m=M)
    coded = E.apply_levels(folded, state, HIGH_CARD, "_te", None, also_on=["fold"])
    return rounded(coded.drop("period", "is_canceled", *HIGH_CARD))


_NOMINAL = {
    "hotel": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "deposit_type": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "customer_type": ["A", "N", "R"],
    "market_segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}
_BUCKETS = ["0-7", "180+", "31-90", "8-30", "91-180", "nan"]


def _dummies(levels) -> str:
    return ", ".join(
        f"""CAST(coalesce({c} = '{v}', false) AS INTEGER) AS "{c}_{v}\""""
        for c, values in levels.items()
        for v in values
    )


@query(
    "one_hot",
    sql_over(BOOKINGS, SPLIT, select=f"SELECT booking_id, {_dummies(_NOMINAL)} FROM test"),
)
def _one_hot(spark, sf):
    train, test, _ = T.time_split(bookings(spark, sf, ["booking_id", "period", *_NOMINAL]))
    return E.one_hot(test, E.train_levels(train, list(_NOMINAL))).drop("period")


# --- the encoded and scaled feature table ------------------------------------------------------------

BOOKING_INPUT = [
    "booking_id",
    "is_canceled",
    "period",
    *FEATURE_INPUT[1:],
    *HIGH_CARD,
    "hotel",
    "customer_type",
]


def encoded_train_test(spark, sf):
    b = engineer(bookings(spark, sf, BOOKING_INPUT), FEATURE_ROLES)
    train, test, _ = T.time_split(stage(b, "featured"))
    return E.encode_train_test(train.drop("period"), test.drop("period"), ROLES, FOLDS, M)


_ENC_EXTRA = (
    "lead_time adr adults children babies previous_cancellations booking_changes "
    "total_of_special_requests is_repeated_guest"
).split()
_ENC_CODES = [*[c + "_freq" for c in HIGH_CARD], *[c + "_te" for c in HIGH_CARD]]


def _encoded_sql(select: str) -> str:
    eng = "lead_time_log adr_log adr_per_guest month_sin month_cos lead_x_nonrefund lead_x_groups".split()
    whole = "has_prev_cancellation has_booking_changes has_special_requests has_children total_guests"
    whole = (whole + " is_solo is_family arrival_month_num is_summer is_peak_season requests_x_repeat risk_score").split()
    e = ", ".join(f"e.{c}" for c in [*eng, *whole])
    raw = ", ".join(f"x.{c}" for c in ["booking_id", "is_canceled", *_ENC_EXTRA])
    dummies = _dummies(_NOMINAL).replace("coalesce(", "coalesce(x.")
    dummies += ", " + _dummies({"lead_time_bucket": _BUCKETS}).replace("coalesce(", "coalesce(e.")
    return sql_over(
        BOOKINGS,
        SPLIT,
        ENGINEERED,
        _fold_sql("train"),
        _levels("train_levels", "train"),
        _levels("folded_levels", "folded", ", fold"),
        _FREQ,
        _TE,
        _OOF,
        f"""train_coded AS (SELECT booking_id, {_wide('freq', 'folded', '_freq', '0.0')},
          {_wide('oof', 'folded', '_te', 'NULL', fold=True)} FROM folded)""",
        f"""test_coded AS (SELECT booking_id, {_wide('freq', 'test', '_freq', '0.0')},
          {_wide('te', 'test', '_te', '(SELECT prior FROM prior)')} FROM test)""",
        "coded AS (SELECT *, 'train' AS side FROM train_coded UNION ALL SELECT *, 'test' FROM test_coded)",
        f"""encoded AS (SELECT {raw}, {e}, {dummies}, c.* EXCLUDE (booking_id)
          FROM bookings x JOIN engineered e USING (booking_id) JOIN coded c USING (booking_id))""",
        select=select,
    )


_ROUNDED = (
    "adr lead_time_log adr_log adr_per_guest month_sin month_cos lead_x_nonrefund lead_x_groups "
    "risk_score"
).split() + _ENC_CODES


@query(
    "encode_all",
    _encoded_sql(
        "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _ROUNDED) + ") FROM encoded"
    ),
)
def _encode_all(spark, sf):
    train, test, _ = encoded_train_test(spark, sf)
    return rounded(
        train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    )


# --- scalers ---------------------------------------------------------------------------------------

_SCALED = ("lead_time", "adr", "price", "booking_changes", "total_of_special_requests")


def _scaler_sql(kind: str) -> str:
    center, spread = {
        "robust": (
            "quantile_cont({c}, 0.5)",
            "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)",
        ),
        "standard": ("avg({c})", "stddev_pop({c})"),
        "minmax": ("min({c})", "max({c}) - min({c})"),
    }[kind]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({center.format(c=c)} AS DOUBLE) AS center, "
        f"CASE WHEN ({spread.format(c=c)}) = 0 THEN 1.0 ELSE CAST({spread.format(c=c)} AS DOUBLE) END AS scale "
        "FROM train"
        for c in _SCALED
    )


def _scaled_sql(kind: str) -> str:
    cols = ", ".join(
        f"round(({c} - (SELECT center FROM st WHERE feature = '{c}')) / "
        f"(SELECT scale FROM st WHERE feature = '{c}'), 6) + 0.0 AS {c}"
        for c in _SCALED
    )
    return sql_over(
        BOOKINGS, SPLIT, f"st AS ({_scaler_sql(kind)})", select=f"SELECT booking_id, {cols} FROM test"
    )


def _scaled(kind):
    def run(spark, sf):
        train, test, _ = T.time_split(staged_bookings(spark, sf, ["booking_id", "period", *_SCALED]))
        return rounded(S.fit_scaler(train, _SCALED, kind).apply(test).drop("period"))

    return run


for _kind in S.KINDS:
    query(f"{_kind}_scale", _scaled_sql(_kind))(_scaled(_kind))

_BINARY = ("is_canceled", "is_repeated_guest", "lead_time", "adults", "booking_changes", "is_solo")


@query(
    "detect_binary",
    sql_over(
        BOOKINGS,
        ENGINEERED,
        select=" UNION ALL ".join(
            f"SELECT '{c}' AS feature, coalesce(bool_and({c} IN (0, 1)), true) AS is_binary "
            f"FROM bookings JOIN engineered USING (booking_id)"
            for c in _BINARY
        ),
    ),
)
def _detect_binary(spark, sf):
    b = engineer(bookings(spark, sf, [*FEATURE_INPUT, "is_canceled"]), FEATURE_ROLES)
    return S.binary_flags_per_column(b, _BINARY)


_CONTINUOUS_INPUT = ("lead_time", "adr", "price", "booking_changes", "is_repeated_guest", "adults")


@query(
    "scale_train_test",
    sql_over(
        BOOKINGS,
        SPLIT,
        "st AS ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS center,
            CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1.0
              ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS scale FROM train"""
            for c in _CONTINUOUS_INPUT
            if c != "is_repeated_guest"
        )
        + ")",
        select="SELECT booking_id, is_canceled, is_repeated_guest, side, "
        + ", ".join(
            f"round(({c} - (SELECT center FROM st WHERE feature = '{c}')) / "
            f"(SELECT scale FROM st WHERE feature = '{c}'), 6) + 0.0 AS {c}"
            for c in _CONTINUOUS_INPUT
            if c != "is_repeated_guest"
        )
        + " FROM (SELECT *, 'train' AS side FROM train UNION ALL SELECT *, 'test' FROM test)",
    ),
)
def _scale_train_test(spark, sf):
    b = staged_bookings(spark, sf, ["booking_id", "period", "is_canceled", *_CONTINUOUS_INPUT])
    train, test, _ = T.time_split(b)
    train, test, _ = S.scale_train_test(
        train.drop("period"), test.drop("period"), "is_canceled", skip=["booking_id"]
    )
    return rounded(
        train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    )
