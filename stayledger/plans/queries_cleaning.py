"""Scans, cleaning, quality and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import flag
from ..operators import cleaning as C
from ..operators import quality as Q
from ..operators import sampling as S
from ..operators.split import time_split
from ..schema import Roles
from ..sources.files import scan_profile
from ..sources.tables import BOOKING_COLUMNS, bookings, table
from .registry import BOOKINGS, SPLIT, hash_key, query, sql_over

ROLES = Roles()
CEILING = 9000.0
PARTY = ("adults", "children", "babies")
SCANNED = ("orders", "lineitem", "customer", "events")


@query(
    "scan_profile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({n} AS INTEGER) AS n_cols FROM {t}"
        for t, n in zip(SCANNED, (6, 11, 5, 6), strict=True)
    ),
)
def _scan_profile(spark, sf):
    out = None
    for name in SCANNED:
        one = scan_profile(table(spark, sf, name), name)
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "hash_sample",
    f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {hash_key('o_orderkey', 'sample')}, "
    "o_orderkey LIMIT 300",
)
def _hash_sample(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return S.sample_n(orders, "o_orderkey", 300, "sample")


@query(
    "hash_sample_fraction",
    f"""WITH r AS (SELECT o_orderkey, o_totalprice,
          row_number() OVER (ORDER BY {hash_key('o_orderkey', 'share')}) AS rn,
          count(*) OVER () AS n FROM orders)
        SELECT o_orderkey, o_totalprice FROM r WHERE rn <= round(0.2 * n)""",
)
def _hash_sample_fraction(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return S.sample_fraction(orders, "o_orderkey", 0.2, "share")


@query(
    "limit_n",
    "SELECT event_id, event_type, value FROM events ORDER BY ts, event_id LIMIT 500",
)
def _limit_n(spark, sf):
    events = table(spark, sf, "events")
    return events.orderBy("ts", "event_id").limit(500).select("event_id", "event_type", "value")


@query(
    "drop_leakage",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, "
    "CAST(o_orderstatus = 'F' AS INTEGER) AS is_canceled FROM orders",
)
def _drop_leakage(spark, sf):
    orders = table(spark, sf, "orders")
    labelled = orders.withColumn("is_canceled", flag(F.col("o_orderstatus") == "F"))
    return C.drop_columns(labelled, ["o_orderstatus", "o_orderdate", "not_there"])


@query(
    "clip_negative",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal "
    "FROM customer",
)
def _clip_negative(spark, sf):
    return C.clip_negative(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query(
    "cap_ceiling",
    "SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN 9000.0 ELSE c_acctbal END AS c_acctbal "
    "FROM customer",
)
def _cap_ceiling(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return C.cap_ceiling(customer, "c_acctbal", CEILING)


@query(
    "drop_zero_guest",
    sql_over(
        BOOKINGS,
        select="""SELECT booking_id, adults, children, babies FROM bookings
        WHERE coalesce(adults, 0) + coalesce(children, 0) + coalesce(babies, 0) > 0""",
    ),
)
def _drop_zero_guest(spark, sf):
    return C.drop_empty_parties(bookings(spark, sf, ["booking_id", *PARTY]), PARTY)


@query(
    "missing_flags",
    sql_over(
        BOOKINGS,
        select="""SELECT booking_id, coalesce(agent, 0) AS agent, coalesce(company, 0) AS company,
          CAST(agent IS NULL AS INTEGER) AS agent_missing,
          CAST(company IS NULL AS INTEGER) AS company_missing,
          coalesce(children, 0) AS children FROM bookings""",
    ),
)
def _missing_flags(spark, sf):
    b = bookings(spark, sf, ["booking_id", "agent", "company", "children"])
    return C.fill_integer(C.fill_with_flag(b, ["agent", "company"]), "children")


@query(
    "dedup_rows",
    "SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem",
)
def _dedup_rows(spark, sf):
    lines = table(spark, sf, "lineitem")
    return C.drop_exact_duplicates(
        lines.select("l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    )


@query(
    "union_dups",
    """WITH u AS (SELECT o_orderkey, o_orderstatus FROM orders UNION ALL
         SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F')
       SELECT o_orderstatus, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys
       FROM u GROUP BY o_orderstatus""",
)
def _union_dups(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    both = orders.unionByName(orders.where(F.col("o_orderstatus") == "F"))
    per_key = both.groupBy("o_orderstatus", "o_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("o_orderstatus").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys")
    )


_MODE = """mode_value AS (SELECT country AS fill FROM train WHERE country IS NOT NULL
  GROUP BY country ORDER BY count(*) DESC, country LIMIT 1)"""


@query(
    "impute_train_mode",
    sql_over(
        BOOKINGS,
        SPLIT,
        _MODE,
        select="""SELECT booking_id, coalesce(country, fill) AS country, side FROM
          (SELECT booking_id, country, 'train' AS side FROM train UNION ALL
           SELECT booking_id, country, 'test' AS side FROM test), mode_value""",
    ),
)
def _impute_train_mode(spark, sf):
    train, test, _ = time_split(bookings(spark, sf, ["booking_id", "period", "country"]))
    (train, test), _ = C.impute_mode(train, [test], "country")
    sides = train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )
    return sides.drop("period")


@query(
    "impute_mode_flag",
    sql_over(
        BOOKINGS,
        SPLIT,
        _MODE,
        select="""SELECT booking_id, coalesce(country, fill) AS country,
          CAST(country IS NULL AS INTEGER) AS country_missing, fill AS fill_value
          FROM test, mode_value""",
    ),
)
def _impute_mode_flag(spark, sf):
    train, test, _ = time_split(bookings(spark, sf, ["booking_id", "period", "country"]))
    (_, test), fill = C.impute_mode(train, [test], "country", with_flag=True)
    return test.drop("period").withColumn("fill_value", F.lit(fill))


CLEAN = f"""cleaned AS (
  SELECT * EXCLUDE (reservation_status, adr, children, agent, company, period, month_num, price),
    CASE WHEN adr < 0 THEN 0.0 WHEN adr > {CEILING} THEN {CEILING} ELSE adr END AS adr,
    coalesce(children, 0) AS children,
    coalesce(agent, 0) AS agent, coalesce(company, 0) AS company,
    CAST(agent IS NULL AS INTEGER) AS agent_missing,
    CAST(company IS NULL AS INTEGER) AS company_missing
  FROM bookings
  WHERE coalesce(adults, 0) + coalesce(children, 0) + coalesce(babies, 0) > 0)"""


@query("clean_bookings", sql_over(BOOKINGS, CLEAN, select="SELECT DISTINCT * FROM cleaned"))
def _clean_bookings(spark, sf):
    b = bookings(spark, sf)
    again = b.where(F.col("is_canceled") == 1)  # double-ingested rows for the copies step
    return C.clean(b.unionByName(again), ROLES, CEILING)


@query(
    "clean_audit",
    sql_over(
        BOOKINGS,
        select=f"""SELECT unnest(['rows', 'negative_price', 'price_above_ceiling', 'empty_party',
            'agent_null', 'company_null', 'children_null']) AS rule,
          unnest([count(*), count(*) FILTER (WHERE adr < 0),
            count(*) FILTER (WHERE adr > {CEILING}),
            count(*) FILTER (WHERE coalesce(adults,0)+coalesce(children,0)+coalesce(babies,0) = 0),
            count(*) FILTER (WHERE agent IS NULL), count(*) FILTER (WHERE company IS NULL),
            count(*) FILTER (WHERE children IS NULL)]) AS n_rows FROM bookings""",
    ),
)
def _clean_audit(spark, sf):
    return C.cleaning_audit(bookings(spark, sf, ["adr", *PARTY, "agent", "company"]), ROLES, CEILING)


@query(
    "clean_remaining_nulls",
    sql_over(
        BOOKINGS,
        CLEAN,
        select=" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS n_null FROM cleaned WHERE {c} IS NULL "
            "HAVING count(*) > 0"
            for c in (*BOOKING_COLUMNS[:-1], "agent_missing", "company_missing")
        ),
    ),
)
def _clean_remaining_nulls(spark, sf):
    return C.remaining_nulls(C.clean(bookings(spark, sf), ROLES, CEILING))


@query(
    "align_schema",
    """SELECT c_custkey, CAST(0 AS INTEGER) AS segment_unknown, c_acctbal,
       CAST(0 AS INTEGER) AS c_missing FROM customer""",
)
def _align_schema(spark, sf):
    expected = ["c_custkey", "segment_unknown", "c_acctbal", "c_missing"]
    return Q.align_schema(table(spark, sf, "customer"), expected)


@query(
    "validate_window",
    """SELECT count(*) AS n_rows,
         count(*) FILTER (WHERE NOT (c_acctbal BETWEEN -1 AND 10000)) AS n_bad,
         true AS has_target,
         count(*) > 0 AND count(*) FILTER (WHERE NOT (c_acctbal BETWEEN -1 AND 10000)) = 0 AS ok
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def _validate_window(spark, sf):
    return Q.window_verdict(bookings(spark, sf, ["is_canceled", "adr"]), "is_canceled", "adr")


_DQ_RULES = {
    "deposit_type_not_allowed": "deposit_type IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
    "lead_time_out_of_range": "lead_time IS NOT NULL AND lead_time >= 0 AND lead_time <= 1000",
    "adults_out_of_range": "adults IS NOT NULL AND adults >= 0 AND adults <= 20",
    "adr_out_of_range": "adr IS NOT NULL AND adr >= 0 AND adr <= 10000",
    "country_missing": "country IS NOT NULL",
}


@query(
    "dq_constraints",
    sql_over(
        BOOKINGS,
        select="SELECT booking_id, "
        + "array_to_string(list_filter(["
        + ", ".join(f"CASE WHEN ({ok}) THEN NULL ELSE '{why}' END" for why, ok in _DQ_RULES.items())
        + "], lambda x: x IS NOT NULL), ',') AS reasons FROM bookings",
    ),
)
def _dq_constraints(spark, sf):
    b = bookings(spark, sf, ["booking_id", "deposit_type", "lead_time", "adults", "adr", "country"])
    rules = [
        Q.one_of("deposit_type", ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
        Q.in_range("lead_time", 0, 1000),
        Q.in_range("adults", 0, 20),
        Q.in_range("adr", 0, 10_000),
        Q.present("country"),
    ]
    tagged = Q.with_reject_reasons(b, rules)
    return tagged.select("booking_id", F.array_join("reasons", ",").alias("reasons"))


@query(
    "row_to_event",
    sql_over(
        BOOKINGS,
        select="""SELECT booking_id AS event_id, hotel, lead_time, deposit_type, country,
          is_canceled AS label FROM bookings""",
    ),
)
def _row_to_event(spark, sf):
    from ..streaming.events import to_event

    b = C.fill_with_flag(bookings(spark, sf), ["agent", "company"])
    event = to_event(b, "booking_id", ROLES)
    text = event.select("event_id", F.to_json("booking").alias("body"), "_true_label")
    fields = F.from_json("body", "hotel string, lead_time int, deposit_type string, country string")
    return text.select(
        "event_id", fields.alias("f"), F.col("_true_label").alias("label")
    ).select("event_id", "f.*", "label")


@query(
    "json_props",
    """SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n
       FROM events GROUP BY ALL""",
)
def _json_props(spark, sf):
    events = table(spark, sf, "events")
    k = F.from_json("props", "k bigint")["k"]
    return events.groupBy("event_type", k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "top_k",
    """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def _top_k(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)
