"""Sharding by a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, file_stage, free_names, text_of, without

# Modulus of the round function; products of two residues stay below 2^62.
ROUND_PRIME = 2_147_483_647
ROUNDS = 6


@dataclass(frozen=True)
class Permutation:
    """A bijection on 0 .. rows-1: `left * right` >= rows, and a walk long enough for every value."""

    rows: int
    left: int
    right: int
    keys: tuple[tuple[int, int], ...]
    walk: int = 1


def round_keys(seed: int, rounds: int = ROUNDS) -> tuple[tuple[int, int], ...]:
    """Two numbers per round, from the seed alone."""
    out = []
    for i in range(rounds):
        digest = hashlib.sha256(f"{seed}:{i}".encode()).digest()
        out.append(
            (
                int.from_bytes(digest[:4], "big") % (ROUND_PRIME - 1) + 1,
                int.from_bytes(digest[4:8], "big") % ROUND_PRIME,
            )
        )
    return tuple(out)


def _cipher(value: Column, p: Permutation) -> Column:
    """One pass of the cipher on 0 .. left*right-1. Halves swap places after each round."""
    rounds = F.array(
        *[
            F.struct(
                F.lit(a).cast("long").alias("a"),
                F.lit(c).cast("long").alias("c"),
                F.lit(p.left if i % 2 == 0 else p.right).cast("long").alias("m"),
            )
            for i, (a, c) in enumerate(p.keys)
        ]
    )

    def step(half: Column, key: Column) -> Column:
        mixed = ((half["y"] % ROUND_PRIME) * key["a"] + key["c"]) % ROUND_PRIME
        return F.struct(
            half["y"].alias("x"), ((half["x"] + mixed * mixed % ROUND_PRIME) % key["m"]).alias("y")
        )

    start = F.struct(
        F.floor(value / p.right).cast("long").alias("x"), (value % p.right).cast("long").alias("y")
    )
    return F.aggregate(rounds, start, step, lambda half: half["x"] * p.right + half["y"])


def permuted(value: Column, p: Permutation) -> Column:
    """Where row `value` lands: the cipher, applied again while the result is not a row number."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(p.walk)),
        _cipher(value, p),
        lambda v, _: F.when(v < p.rows, v).otherwise(_cipher(v, p)),
    )


def plan_permutation(spark: SparkSession, rows: int, seed: int) -> Permutation:
    """The permutation of `rows` rows.

    The two halves have near equal sizes whose product exceeds `rows` by less than one side, so
    fewer than sqrt(rows) values lie outside. The walk length is proven on all of them: it is
    doubled until each one has come back inside, or to itself (a cycle that no row number enters).
    """
    right = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    left = max(1, -(-rows // right))
    p = Permutation(rows, left, right, round_keys(seed))
    while True:
        start = F.col("id")
        end = F.aggregate(
            F.array_repeat(F.lit(0), p.walk - 1),
            _cipher(start, p),
            lambda v, _: F.when((v < rows) | (v == start), v).otherwise(_cipher(v, p)),
        )
        outside = spark.range(rows, left * right).select((end >= rows) & (end != start))
        if not outside.toDF("open").where("open").limit(1).collect():
            return p
        p = Permutation(rows, left, right, p.keys, p.walk * 2)


def number_rows(df: DataFrame, id_col: str, text_col: str, name: str) -> tuple[DataFrame, int]:
    """Global row numbers 0, 1, ... in the order of (id, text), and the number of rows.

    Rows are dealt into ranges of (id, hash of the text, position), so repeated rows, null ids and
    equal texts spread over ranges; each range is sorted and written as files once. A row's number
    is the count of rows in earlier files plus its position in its file. Only the counts of the
    files are summed over, and the written files stay as they are when executors are lost.
    """
    mark, tie, base, file_name = free_names(df, "_mark", "_tie", "_base", "_file")
    order = [
        col(id_col).asc_nulls_first(),
        F.col(mark),
        F.col(tie),
    ]
    dealt = (
        df.withColumn(mark, F.xxhash64(text_of(text_col)))
        .withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop(mark, tie)
    )
    written = file_stage(dealt, "numbered").select(
        "*",
        F.col("_metadata.file_name").alias(file_name),
        F.col("_metadata.row_index").alias(base),
    )
    # One row per written file: the number of range partitions bounds it.
    counts = sorted(
        (r[0], r[1]) for r in written.groupBy(F.col(file_name)).agg(F.count(F.lit(1))).collect()
    )
    starts, total = [], 0
    for f, n in counts:
        starts.append((f, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts, f"{file_name} string, {name} long")
    numbered = written.join(F.broadcast(offsets), file_name).withColumn(
        name, F.col(name) + F.col(base)
    )
    return numbered.drop(file_name, base), total


def shard(
    df: DataFrame,
    shards: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 17,
) -> DataFrame:
    """All rows of `df` with `row_number`, `shard` and `slot`; columns of these names are replaced.

    Rows are numbered in the order of (id, text hash), the number is permuted by a keyed Feistel
    cipher on 0 .. rows-1, and position p goes to shard p mod `shards`, slot p div `shards`. So shard
    sizes differ by one row at most, slots have no gaps, and `where` computes shard and slot of a
    row number without any table. The same rows and seed give the same shuffle on any cluster;
    rows equal in id and text are interchangeable.

    Null ids come first, null and empty texts order alike, repeated rows get places of their own,
    and an empty table stays empty with the same columns.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    kept = df.select(*without(df, ("row_number", "shard", "slot")))
    numbered, rows = number_rows(kept, id_col, text_col, "row_number")
    p = plan_permutation(df.sparkSession, rows, seed)
    place = free_names(numbered, "_place")[0]
    at = numbered.withColumn(place, permuted(F.col("row_number"), p))
    return at.select(
        *[col(c) for c in kept.columns],
        "row_number",
        (F.col(place) % shards).cast("int").alias("shard"),
        F.floor(F.col(place) / shards).cast("long").alias("slot"),
    )


def where(row_number: int, rows: int, shards: int, seed: int = 17) -> tuple[int, int]:
    """Shard and slot of one row number, in plain Python: what a reader of the shards computes."""
    right = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    left = max(1, -(-rows // right))
    value = row_number
    while True:
        x, y = divmod(value, right)
        for i, (a, c) in enumerate(round_keys(seed)):
            mixed = ((y % ROUND_PRIME) * a + c) % ROUND_PRIME
            x, y = y, (x + mixed * mixed % ROUND_PRIME) % (left if i % 2 == 0 else right)
        value = x * right + y
        if value < rows:
            return value % shards, value // shards


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of query 1: all documents in shards 0 to 39, law `rows`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = text_of("text")
    return shard(docs, 40).select(
        "doc_id",
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def oracle(seed: int = 17, shards: int = 40) -> str:
    """The same placement in DuckDB: ranks, unrolled rounds, and a recursive walk."""
    steps = []
    for i, (a, c) in enumerate(round_keys(seed)):
        side = "lft" if i % 2 == 0 else "rgt"
        mixed = f"(((y % {ROUND_PRIME}) * {a} + {c}) % {ROUND_PRIME})"
        steps.append(
            f"r{i + 1} AS (SELECT v, lft, rgt, n, y AS x, "
            f"(x + {mixed} * {mixed} % {ROUND_PRIME}) % {side} AS y FROM r{i})"
        )
    return f"""
WITH RECURSIVE sized AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS rgt
  FROM documents),
dims AS (SELECT n, rgt, CAST(ceil(n * 1.0 / rgt) AS BIGINT) AS lft FROM sized),
r0 AS (SELECT v, lft, rgt, n, v // rgt AS x, v % rgt AS y
  FROM dims, LATERAL (SELECT unnest(range(lft * rgt)) AS v)),
{", ".join(steps)},
cipher AS (SELECT v, x * rgt + y AS w, n FROM r{len(steps)}),
walk(rn, w, n) AS (SELECT v, w, n FROM cipher WHERE v < n
  UNION ALL SELECT walk.rn, cipher.w, walk.n FROM walk JOIN cipher ON cipher.v = walk.w
  WHERE walk.w >= walk.n),
placed AS (SELECT rn, w FROM walk WHERE w < n),
poly AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
numbered AS (SELECT doc_id, coalesce(text, '') AS text,
  row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS rn FROM documents),
bytes AS (SELECT doc_id, rn, list_transform(regexp_extract_all(hex(encode(text)), '..'),
  lambda h: CAST('0x' || h AS BIGINT)) AS b FROM numbered)
SELECT doc_id, CAST(len(b) + 16 AS BIGINT) AS size,
  CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
    lambda c, v: xor(t[(xor(c, v) & 255) + 1], c >> 8)), 4294967295) AS BIGINT) AS text_crc32,
  'rows' AS law, CAST(w % {shards} AS INTEGER) AS shard, CAST(w // {shards} AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM bytes JOIN placed USING (rn), poly"""
