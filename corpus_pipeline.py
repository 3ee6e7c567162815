"""The corpus pipeline: toxicity, near duplicates, decontamination, mixing, sharding.

Each stage reads what its predecessor kept and returns the columns of documents; the last one adds
the place in the shards. A stage's result is written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.llm import decontaminate, mixing, near, sharding, toxicity
from stayledger.session import work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHARDS = 40
# Share of the tokens that the mix takes, in one epoch, so that no document comes twice.
MIX_SHARE = 0.9
READ = ("doc_id", "text", "lang", "source")


def shielded(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], list[Column]]]:
    """`docs` with neutral names for all columns that no operator reads, and a way back.

    Whatever a table carries beside READ (a score, items, a shard, names with dots) then clashes with
    no column that an operator writes.
    """
    plain = [c if c in READ else f"carried {k}" for k, c in enumerate(docs.columns)]

    def back(df: DataFrame, without: Sequence[str] = ()) -> list[Column]:
        pairs = zip(plain, docs.columns, strict=True)
        return [df[f"`{p}`"].alias(c) for p, c in pairs if c not in without]

    return docs.toDF(*plain), back


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold of query 3.

    Null and empty texts have a score like any others; repeated rows get equal scores and go or stay
    together; an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plain, back = shielded(docs)
    field = toxicity.fit_toxicity(plain, labels)
    mild = toxicity.score_toxicity(plain, field).where(F.col("score") < toxicity.THRESHOLD)
    return mild.select(*back(mild))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the smallest id.

    Texts without words (null, empty, blank) all stay; of wholly equal rows one stays.
    """
    plain, back = shielded(docs)
    kept = near.keep_one(plain)
    return kept.select(*back(kept))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no span with the benchmark; null and empty texts stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    plain, back = shielded(docs)
    clean = decontaminate.mark_contaminated(plain, benchmark).where(~F.col("contaminated"))
    return clean.select(*back(clean))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MIX_SHARE of the tokens by the target weights of query 9 for domains and languages; sources of
    a node weigh alike.

    Each document is taken once at most. Nodes too small for their share are taken whole and their
    shortage goes to siblings first, so only nodes above their target lose documents. Null and empty
    texts have no tokens and cost no budget; rows of equal id are taken together.
    """
    plain, back = shielded(docs)
    mixed = mixing.mix(
        plain,
        levels={"domain": mixing.domain(), "lang": F.col("lang"), "source": F.col("source")},
        weights=[mixing.DOMAIN_WEIGHTS, mixing.LANG_WEIGHTS, {}],
        budget_share=MIX_SHARE,
    )
    return mixed.select(*back(mixed))


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot, which replace columns of these names."""
    plain, back = shielded(docs)
    placed = sharding.shard(plain, SHARDS)
    return placed.select(*back(placed, ("shard", "slot")), "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

# Scores of a fitted field and MinHash candidates have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
