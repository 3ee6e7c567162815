"""Line dedup: a sharded minimal perfect hash over line hashes, probed by documents.

Lines are never joined with lines. All distinct line hashes are dealt to shards; a shard is one row
that holds a minimal perfect hash and, at the places it gives, compact arrays of fingerprints, counts
and keepers. The hashes of the documents stream past the shard that owns them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, col, file_stage, free_names, text_of, without

MIN_CHARS = 20  # code points of a key that can be dropped
MIN_DOCS = 3  # documents that make it repeated
SHARD_KEYS = 1 << 14  # expected keys of a shard
HOT_SHARDS = 1000  # shards that get more than one task, at most
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROOM = 2  # slots a key gets in each level of the perfect hash

SHARD_TYPE = (
    "shard long, probes long, sizes array<int>, bits binary, prints binary, counts binary, "
    "count_type string, keepers binary"
)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def key_of(line: Column) -> Column:
    """The line without blanks at its ends and with A to Z in lower case."""
    bare = F.btrim(line, F.lit(SPACES))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _spot(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    """The slot of each 128-bit key in a level."""
    x = a + b * np.uint64(2 * level + 1)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


def build_hash(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """A minimal perfect hash of the distinct keys (a, b): their places 0 to n - 1, the sizes of its
    levels and their bits.

    A key stays in the first level where it has a slot to itself, and the set bits before its own
    are its place; the others go down to the next level.
    """
    place = np.full(len(a), -1, np.int64)
    left, sizes, bits, base, level = np.arange(len(a)), [], [], 0, 0
    while left.size:
        size = max(8, ROOM * left.size)
        at = _spot(a[left], b[left], level, size)
        single = np.bincount(at, minlength=size) == 1
        alone = single[at]
        place[left[alone]] = base + np.cumsum(single)[at[alone]] - 1
        base += int(single.sum())
        sizes.append(size)
        bits.append(single)
        left, level = left[~alone], level + 1
    return place, sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def find_place(a: np.ndarray, b: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The place of each key; a key that was not built in gets -1 or the place of another."""
    place = np.full(len(a), -1, np.int64)
    left, start, base = np.arange(len(a)), 0, 0
    for level, size in enumerate(sizes):
        own = bits[start : start + size]
        rank = np.cumsum(own)
        at = _spot(a[left], b[left], level, size)
        hit = own[at]
        place[left[hit]] = base + rank[at[hit]] - 1
        left, start, base = left[~hit], start + size, base + int(rank[-1])
    return place


def _unsigned(values: pd.Series) -> np.ndarray:
    return values.to_numpy(np.int64).view(np.uint64)


def _build_shard(keys: pd.DataFrame) -> pd.DataFrame:
    a, b = _unsigned(keys["a"]), _unsigned(keys["b"])
    place, sizes, bits = build_hash(a, b)
    counts = keys["n"].to_numpy(np.int64)
    narrow = np.min_scalar_type(int(counts.max()))

    def laid(values: np.ndarray, kind: np.dtype | type) -> bytes:
        out = np.empty(len(values), kind)
        out[place] = values.astype(kind)
        return out.tobytes()

    row = {
        "shard": int(keys["shard"].iloc[0]),
        "probes": int(counts.sum()),
        "sizes": sizes,
        "bits": np.packbits(bits).tobytes(),
        "prints": laid(b & np.uint64(0xFFFFFFFF), np.uint32),
        "counts": laid(counts, narrow),
        "count_type": narrow.name,
        "keepers": laid(keys["keeper"].to_numpy(np.int64), np.int64),
    }
    return pd.DataFrame([row])


class Shard:
    """One row of the index, opened for probing."""

    def __init__(self, row: pd.Series) -> None:
        self.sizes = [int(x) for x in row["sizes"]]
        packed = np.frombuffer(row["bits"], np.uint8)
        self.bits = np.unpackbits(packed, count=sum(self.sizes)).astype(bool)
        self.prints = np.frombuffer(row["prints"], np.uint32)
        self.counts = np.frombuffer(row["counts"], row["count_type"])
        self.keepers = np.frombuffer(row["keepers"], np.int64)

    def probe(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and keeper of each key; the count is 0 where the fingerprint differs."""
        place = find_place(a, b, self.sizes, self.bits)
        at = np.maximum(place, 0)
        own = (place >= 0) & (self.prints[at] == (b & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        return np.where(own, self.counts[at], 0).astype(np.int64), self.keepers[at]


def line_hashes(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, doc, body, keys): the id, hashes of id and text, and a 128-bit hash (a, b) of each
    distinct key of the row with `min_chars` code points at least."""
    text = text_of(text_col)
    keys = F.array_distinct(
        F.filter(F.transform(lines_of(text), key_of), lambda k: F.length(k) >= min_chars)
    )
    pair = F.transform(
        keys, lambda k: F.struct(F.xxhash64(k).alias("a"), F.xxhash64(F.lit(1), k).alias("b"))
    )
    return df.select(
        col(id_col).alias("id"),
        F.xxhash64(col(id_col)).alias("doc"),
        F.xxhash64(text).alias("body"),
        pair.alias("keys"),
    )


def build_index(hashed: DataFrame, shards: int) -> DataFrame:
    """A row of SHARD_TYPE for each shard of the distinct line hashes of `hashed`.

    Counts and largest ids fold map-side, so a line that every document holds costs one row a task.
    """
    pairs = hashed.select("id", F.explode("keys").alias("k")).select("id", "k.a", "k.b")
    distinct = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("id"))
    dealt = distinct.select(
        F.pmod("a", F.lit(shards)).alias("shard"), "a", "b", "n", F.xxhash64("id").alias("keeper")
    )
    return dealt.groupBy("shard").applyInPandas(_build_shard, SHARD_TYPE)


def probe_index(hashed: DataFrame, index: DataFrame, shards: int, lines: int, min_docs: int) -> DataFrame:
    """(doc, body, a): the line hashes that a row must drop.

    A shard's row comes first in its partition and its probes stream past it, so a task holds one
    shard and one batch. A shard with more than a thousandth of all probes is copied to several
    tasks; such shards are HOT_SHARDS at most, so their list may be broadcast.
    """
    limit = max(SHARD_KEYS, lines // HOT_SHARDS)
    salted = index.withColumn("salts", F.ceil(F.col("probes") / limit))
    hot = salted.where("salts > 1").select("shard", "salts")
    probes = (
        hashed.select("doc", "body", F.explode("keys").alias("k"))
        .select(F.pmod("k.a", F.lit(shards)).alias("shard"), "doc", "body", "k.a", "k.b")
        .join(F.broadcast(hot), "shard", "left")
        .withColumn("salt", F.pmod(F.xxhash64("doc", "body"), F.coalesce("salts", F.lit(1))))
        .drop("salts")
    )
    arrays = ["sizes", "bits", "prints", "counts", "count_type", "keepers"]
    copies = salted.select(
        "shard",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
        *arrays,
        *[F.lit(0).cast("long").alias(x) for x in ("doc", "body", "a", "b")],
        F.lit(0).alias("kind"),
    )
    stream = copies.unionByName(probes.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    order = ["shard", "salt", "kind"]

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = None
        for rows in batches:
            spot = rows[["shard", "salt"]].to_numpy(np.int64)
            kind = rows["kind"].to_numpy()
            fresh = np.r_[True, (spot[1:] != spot[:-1]).any(axis=1)] if len(rows) else np.zeros(0, bool)
            starts = np.flatnonzero(fresh)
            for start, end in zip(starts, np.r_[starts[1:], len(rows)], strict=True):
                if kind[start] == 0:
                    shard, start = Shard(rows.iloc[start]), start + 1
                own = rows.iloc[start:end]
                if own.empty:
                    continue
                count, keeper = shard.probe(_unsigned(own["a"]), _unsigned(own["b"]))
                gone = (count >= min_docs) & (keeper != own["doc"].to_numpy(np.int64))
                yield own.loc[gone, ["doc", "body", "a"]].astype("int64")

    dealt = stream.repartition("shard", "salt").sortWithinPartitions(*order)
    return dealt.mapInPandas(answer, "doc long, body long, a long")


def _cut(text: pd.Series, marks: pd.Series, gone: pd.Series) -> pd.DataFrame:
    """The text without the lines whose mark is in `gone`, and their number."""
    out, n = [], []
    for t, m, g in zip(text, marks, gone, strict=True):
        if t is None:
            out.append(None)
            n.append(0)
            continue
        lost = set(g)
        kept = [line for line, mark in zip(t.split("\n"), m, strict=True) if mark is None or mark not in lost]
        out.append("\n".join(kept))
        n.append(len(m) - len(kept))
    return pd.DataFrame({"text": out, "n": n})


def _marks(text: Column, min_chars: int) -> Column:
    """The hash of each line's key as text (exact in every reader), null where the key is short."""
    return F.transform(
        F.transform(lines_of(text), key_of),
        lambda k: F.when(F.length(k) >= min_chars, F.xxhash64(k).cast("string")),
    )


def drop_repeated_lines(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """`df` with its text cut, n_lines (before) and n_dropped.

    A key of `min_chars` code points at least that `min_docs` rows hold loses all its lines, except
    in the rows of the largest id that holds it. A null or empty text is one empty line and stays as
    it is, and so does the text of every row that loses nothing. Each row counts as a document;
    repeated rows of the largest id all keep their lines. A null id is below all others. An empty
    table stays empty; columns named n_lines or n_dropped are replaced and others stay. Keys are
    compared by a 128-bit hash, within a row by 64 bits of it; ids by a 64-bit hash, which is one to
    one for integers.
    """
    hashed = file_stage(line_hashes(df, id_col, text_col, min_chars), "hashed")
    lines = hashed.agg(F.sum(F.size("keys"))).first()[0] or 0
    shards = lines // SHARD_KEYS + 1
    index = file_stage(build_index(hashed, shards), "index")
    losses = probe_index(hashed, index, shards, lines, min_docs)
    found = losses.groupBy("doc", "body").agg(F.collect_set(F.col("a").cast("string")).alias("gone"))
    kept = df.select(*without(df, ("n_lines", "n_dropped")))
    doc, body, cut = free_names(kept, "_doc", "_body", "_cut")
    lost_doc, lost_body, gone = free_names(kept, "_lost_doc", "_lost_body", "_gone")
    text = text_of(text_col)
    rows = kept.select("*", F.xxhash64(col(id_col)).alias(doc), F.xxhash64(text).alias(body))
    lost = found.select(
        F.col("doc").alias(lost_doc), F.col("body").alias(lost_body), F.col("gone").alias(gone)
    )
    # Losses grow with the corpus, so they are joined by shuffle at every size.
    met = rows.join(
        lost.hint("merge"), (col(doc) == col(lost_doc)) & (col(body) == col(lost_body)), "left"
    )
    touched = col(gone).isNotNull()
    cutter = F.pandas_udf(_cut, "text string, n long")
    cutting = met.withColumn(
        cut,
        cutter(F.when(touched, text), F.when(touched, _marks(text, min_chars)), col(gone)),
    )
    return cutting.select(
        *[
            F.when(touched, col(cut)["text"]).otherwise(col(c)).alias(c) if c == text_col else col(c)
            for c in kept.columns
        ],
        F.size(lines_of(text)).cast("long").alias("n_lines"),
        F.when(touched, col(cut)["n"]).otherwise(0).cast("long").alias("n_dropped"),
    )


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of query 11."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(text_of("text"), 256).alias("kept_sha256")
    )


ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  '{UPPER}', '{UPPER.lower()}') AS key FROM lines),
often AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT r) >= {MIN_DOCS}),
judged AS (SELECT keyed.*, keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone
  FROM keyed LEFT JOIN often USING (key))
SELECT min(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r"""
