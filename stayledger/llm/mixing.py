"""Mixing sources to target weights: hierarchical token budgets, filled from seeded epochs."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACES, col, file_stage, free_names, text_of, without

HASH_BITS = 52
GAP = "[\\x20\\x09-\\x0D]+"
MISSING = "<null>"
# Rows of one hash bucket are sorted together; more rows mean more buckets, not larger ones.
BUCKET_ROWS = 65_536
# The leaf table goes to every executor up to this many leaves, else it joins by shuffle.
BROADCAST_LEAVES = 100_000


def tokens_of(text: Column) -> Column:
    """Words of the text, the unit of all budgets."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, GAP))).cast("long")


def epoch_hash(key: Column, seed: int, epoch: Column) -> Column:
    """52 bits of md5: the place of a document in one epoch's order."""
    digest = F.md5(F.concat(key, F.lit(f"-{seed}-"), epoch.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def weight_of(level: Column, weights: Mapping[str, int]) -> Column:
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    out = F.lit(1).cast("long")
    for name, w in sorted(weights.items()):
        out = F.when(level == name, F.lit(w).cast("long")).otherwise(out)
    return out


def allocate(nodes: DataFrame, parent: Sequence[str]) -> DataFrame:
    """`nodes` (parent columns, node, cap, weight, budget of the parent) with `given`.

    Children share the parent's budget by weight; one that cannot use its share gets its capacity,
    and what it leaves goes to its siblings by weight, until none is short. Shares are whole tokens.
    Only a parent whose children are all full leaves anything to its own siblings, since its
    capacity is their sum.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), "node")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    later = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    fits = F.col("cap") * F.sum("weight").over(later) <= left * F.col("weight")
    tested = nodes.withColumn("fits", fits).withColumn("full", F.min("fits").over(upto))
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))
    rest = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    spread = tested.withColumn("taken", taken).withColumn("rest", rest)
    share = F.expr("((budget - taken) * weight) div rest")
    return spread.withColumn("given", F.when(F.col("full"), F.col("cap")).otherwise(share)).drop(
        "fits", "full", "taken", "rest"
    )


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Sequence[Mapping[str, int]], budget: int
) -> DataFrame:
    """`leaves` (levels, cap) with `given`: the budget carried down the tree, level by level."""
    above = None
    for depth, level in enumerate(levels):
        path = list(levels[:depth])
        caps = leaves.groupBy(*path, F.col(level).alias("node")).agg(F.sum("cap").alias("cap"))
        total = F.lit(budget).cast("long")
        joined = caps.join(above, path) if above else caps.withColumn("budget", total)
        nodes = joined.withColumn("weight", weight_of(F.col("node"), weights[depth]))
        given = allocate(nodes, path)
        above = file_stage(
            given.select(*path, F.col("node").alias(level), F.col("given").alias("budget")),
            "budgets",
        )
    return leaves.join(above.withColumnRenamed("budget", "given"), list(levels))


def cut_points(
    slim: DataFrame, leaves: DataFrame, levels: Sequence[str], seed: int, bits: int
) -> DataFrame:
    """Per leaf with a part epoch: the largest hash whose token prefix fits into `part`.

    Tokens are summed per (leaf, hash bucket) first, map-side, so a leaf with a third of all rows
    is 2^bits sums; only the bucket in which the budget ends is sorted. Rows of equal hash are taken
    together or not at all.
    """
    on = list(levels)
    wanted = leaves.where(F.col("part") > 0).select(*on, "full", "part")
    shift = HASH_BITS - bits
    hashed = small_join(slim, wanted, on).withColumn(
        "h", epoch_hash(F.col("key"), seed, F.col("full"))
    )
    placed = hashed.withColumn("bucket", F.shiftright("h", shift))
    held = placed.groupBy(*on, "part", "bucket").agg(F.sum("tokens").alias("held"))
    upto = Window.partitionBy(*on).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    summed = held.withColumn("upto", F.sum("held").over(upto))
    ends = file_stage(
        summed.where(F.col("upto") > F.col("part"))
        .groupBy(*on)
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("held")).alias("before"))).alias("end"))
        .select(*on, F.col("end.bucket").alias("last"), F.col("end.before").alias("before")),
        "ends",
    )
    inside = small_join(placed, ends, on).where(F.col("bucket") == F.col("last"))
    per_hash = inside.groupBy(*on, "part", "before", "h").agg(F.sum("tokens").alias("tokens"))
    run = Window.partitionBy(*on).orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    fitting = (
        per_hash.withColumn("total", F.col("before") + F.sum("tokens").over(run))
        .where(F.col("total") <= F.col("part"))
        .groupBy(*on)
        .agg(F.max("h").alias("reached"))
    )
    floor = F.shiftleft("last", shift) - 1
    return ends.join(fitting, on, "left").select(
        *on, F.coalesce("reached", floor).alias("cut")
    )


def small_join(rows: DataFrame, leaves: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with their leaf: by broadcast if the leaves were counted and are few, else by shuffle,
    where Spark can split a leaf that holds a large part of the rows."""
    few = leaves.count() <= BROADCAST_LEAVES
    return rows.join(F.broadcast(leaves) if few else leaves.hint("merge"), list(on))


def mix(
    df: DataFrame,
    *,
    levels: Mapping[str, Column],
    weights: Sequence[Mapping[str, int]],
    budget: int | None = None,
    budget_share: float | None = None,
    max_epochs: int = 1,
    seed: int = 29,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of the mix: `df` with `epoch` and `tokens`, one row per epoch that takes a document.

    `levels` names the tree from the root down, such as domain, language and source; `weights` has
    for each level the weight of a value among its siblings (1 if absent). The token budget
    (`budget`, or `budget_share` of all tokens) goes down the tree by weight. A leaf can give
    `max_epochs` times its tokens; what it cannot give goes to its siblings, and to siblings of its
    ancestors only when those are full too. A leaf's budget is filled by whole epochs and then by
    the longest prefix, in the seeded order of the next epoch, whose tokens fit.

    A null level value is the value `<null>`; null and empty texts have no tokens and are taken with
    their place in the order, in every epoch where a leaf has no tokens at all; a null id is ordered by its text; rows of equal id are taken together;
    an empty table gives an empty mix. Columns named epoch or tokens are replaced, and columns of
    any other name stay.
    """
    kept = df.select(*without(df, ("epoch", "tokens")))
    names = free_names(kept, *[f"_{x}" for x in levels])
    key, full, cut, n = free_names(kept, "_key", "_full", "_cut", "_n")
    paths = [
        F.coalesce(c.cast("string"), F.lit(MISSING)).alias(n)
        for n, c in zip(names, levels.values(), strict=True)
    ]
    text = text_of(text_col)
    ident = F.coalesce(col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(text))).alias(key)
    slim = file_stage(
        df.select(*paths, ident, tokens_of(text).alias("tokens")).withColumnRenamed(key, "key"),
        "tokens",
    )
    totals = slim.groupBy(*names).agg(
        F.sum("tokens").alias("supply"), F.count(F.lit(1)).alias("docs")
    )
    supplied = file_stage(totals.withColumn("cap", F.col("supply") * max_epochs), "leaves")
    all_tokens, rows = supplied.agg(F.sum("supply"), F.sum("docs")).first()
    if budget is None:
        budget = int((all_tokens or 0) * (1.0 if budget_share is None else budget_share))
    bits = min(40, max(8, math.ceil(math.log2((rows or 1) / BUCKET_ROWS + 1))))
    given = leaf_budgets(supplied, names, weights, budget)
    unit = F.greatest(F.col("supply"), F.lit(1))
    leaves = file_stage(
        given.withColumn(
            "full", F.when(F.col("supply") == 0, F.lit(max_epochs)).otherwise(F.expr("given div greatest(supply, 1)"))
        ).withColumn(
            "part", F.col("given") - F.col("full") * unit
        ),
        "given",
    )
    cuts = cut_points(slim, leaves, names, seed, bits)
    plan = file_stage(
        leaves.join(cuts, names, "left").select(
            *names, F.col("full").alias(full), F.coalesce("cut", F.lit(-1)).alias(cut)
        ),
        "plan",
    )
    rows_of = kept.select("*", *paths, ident)
    met = small_join(rows_of, plan, names)
    more = epoch_hash(col(key), seed, col(full)) <= col(cut)
    copies = col(full) + more.cast("long")
    taken = met.withColumn(n, copies).where(col(n) > 0)
    return taken.select(
        *[col(c) for c in kept.columns],
        F.explode(F.sequence(F.lit(0), (col(n) - 1).cast("int"))).alias("epoch"),
        tokens_of(text).alias("tokens"),
    )


SOURCE_NUMBER = "[0-9]+$"
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 4, "fr": 2, "de": 2}


def domain() -> Column:
    """The domain of a source: its number modulo 4."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), SOURCE_NUMBER, 0).try_cast("long")
    return F.concat(F.lit("d"), (F.coalesce(number, F.lit(0)) % 4).cast("string"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as the corpus has, three epochs at most, by domain, language and source."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "text", "lang", "source"
    )
    mixed = mix(
        docs.withColumn("domain", domain()),
        levels={"domain": F.col("domain"), "lang": F.col("lang"), "source": F.col("source")},
        weights=[DOMAIN_WEIGHTS, LANG_WEIGHTS, {}],
        budget_share=1.0,
        max_epochs=3,
    )
    return mixed.select("doc_id", "domain", "lang", "source", "epoch", "tokens")


def _sql_weight(node: str, weights: Mapping[str, int]) -> str:
    cases = " ".join(f"WHEN {node} = '{k}' THEN {w}" for k, w in sorted(weights.items()))
    return f"CASE {cases} ELSE 1 END" if cases else "1"


def oracle(seed: int = 29, max_epochs: int = 3) -> str:
    weights = [DOMAIN_WEIGHTS, LANG_WEIGHTS, {}]
    levels = ["domain", "lang", "source"]
    steps = []
    for d, level in enumerate(levels):
        path = levels[:d]
        part = f"PARTITION BY {', '.join(path)}" if path else ""
        keep = "".join(f"{p}, " for p in path)
        source = f"b{d - 1} USING ({', '.join(path)})" if path else "(SELECT sum(tokens) AS given FROM slim) ON true"
        steps.append(
            f"""n{d} AS (SELECT c.*, given AS budget, {_sql_weight(level, weights[d])} AS weight
  FROM (SELECT {keep}{level}, sum(cap) AS cap FROM leaves GROUP BY ALL) c JOIN {source}),
f{d} AS (SELECT *, cap * sum(weight) OVER ({part} ORDER BY cap / weight, {level}
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
  <= (budget - coalesce(sum(cap) OVER ({part} ORDER BY cap / weight, {level}
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS fits FROM n{d}),
s{d} AS (SELECT *, min(fits) OVER ({part} ORDER BY cap / weight, {level}
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done FROM f{d}),
b{d} AS (SELECT {keep}{level}, CASE WHEN done THEN cap
  ELSE ((budget - coalesce(sum(CASE WHEN done THEN cap END) OVER ({part}), 0)) * weight)
    // sum(CASE WHEN NOT done THEN weight END) OVER ({part}) END AS given FROM s{d})"""
        )
    return f"""
WITH docs AS (SELECT doc_id, lang, source,
  'd' || (coalesce(TRY_CAST(regexp_extract(source, '{SOURCE_NUMBER}') AS BIGINT), 0) % 4) AS domain,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens
  FROM documents),
slim AS (SELECT * FROM docs),
leaves AS (SELECT domain, lang, source, sum(tokens) AS supply, sum(tokens) * {max_epochs} AS cap
  FROM slim GROUP BY ALL),
{", ".join(steps)},
parts AS (SELECT domain, lang, source,
  CASE WHEN supply = 0 THEN {max_epochs} ELSE given // greatest(supply, 1) END AS whole,
  given - given // greatest(supply, 1) * greatest(supply, 1) AS part
  FROM leaves JOIN b2 USING (domain, lang, source)),
hashed AS (SELECT docs.*, whole, part,
  CAST('0x' || substr(md5(doc_id || '-{seed}-' || whole), 1, 13) AS BIGINT) AS h
  FROM docs JOIN parts USING (domain, lang, source)),
runs AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h) AS upto
  FROM hashed),
copies AS (SELECT *, whole + CASE WHEN part > 0 AND upto <= part THEN 1 ELSE 0 END AS n FROM runs)
SELECT doc_id, domain, lang, source, CAST(unnest(range(CAST(n AS BIGINT))) AS INTEGER) AS epoch,
  tokens FROM copies"""
