"""N-gram Jaccard join by a MinHash LSH forest with exact verification."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, col, file_stage, free_names, table, text_of, without
from .components import components

GAP = re.compile(r"[^\x20\x09-\x0D]+")
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Forest:
    """`trees` tries over signatures of `depth` values.

    Matching begins at whole signatures and shortens their prefixes by `step` values a round, but only
    below nodes that still hold texts of several groups, and never below `shortest`.
    """

    threshold: float = 0.8
    shingle: int = 5
    trees: int = 32
    depth: int = 10
    step: int = 2
    recall: float = 0.9999
    seed: int = 41

    def recall_at(self, length: int) -> float:
        """Chance that two texts of just the threshold share a prefix of this length in some tree."""
        return 1 - (1 - self.threshold**length) ** self.trees

    @property
    def shortest(self) -> int:
        """The longest prefix whose recall is the target; shorter ones add work only."""
        for length in range(self.depth, 0, -1):
            if self.recall_at(length) >= self.recall:
                return length
        raise ValueError("more trees are needed for this recall")

    @property
    def longest(self) -> int:
        """A path keeps 7 values below its shortest prefix at most, a byte of each."""
        return min(self.depth, self.shortest + 7)

    @property
    def lengths(self) -> list[int]:
        return [*range(self.longest, self.shortest, -self.step), self.shortest]

    def node(self, length: int) -> list[Column]:
        """The node of a path (label, tail) at this prefix length."""
        cut = F.shiftright("tail", 8 * (self.longest - length))
        return [F.col("label"), cut.alias("twig")]


def grown(df: DataFrame) -> DataFrame:
    """A side that grows with the corpus: joined by shuffle at every size, never broadcast."""
    return df.hint("merge")


class _Words(dict):
    def __missing__(self, word: str) -> int:
        raw = word.encode()
        at = self[word] = zlib.crc32(raw) << 32 | zlib.crc32(raw, 0x5BD1E995)
        return at


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sets of 64-bit hashes of `size` consecutive words; letters count without their case.

    A text of fewer words, but not none, is one shingle.
    """

    def __init__(self, size: int) -> None:
        self.size, self.words = size, _Words()

    def of(self, text: str, *, distinct: bool = True) -> np.ndarray:
        if len(self.words) > 400_000:
            self.words.clear()
        h = np.fromiter(map(self.words.__getitem__, GAP.findall(text.lower())), np.uint64)
        if not len(h):
            return h
        take = min(self.size, len(h))
        out = np.zeros(len(h) - take + 1, np.uint64)
        for k in range(take):
            out = _mixed(out * MIX + h[k : len(h) - take + 1 + k] + np.uint64(take))
        return np.unique(out) if distinct else out


def signatures(docs: DataFrame, forest: Forest) -> DataFrame:
    """(text, key) rows as (key, size, labels, tails): shingle count and the path of each tree.

    A path is a label, the hash of its tree's number and the shortest prefix, and a tail, a byte of
    each further value; paths in order of label and tail are the trie, and its nodes are ranges.
    """
    rng = np.random.default_rng(forest.seed)
    shortest, depth = forest.shortest, forest.longest
    count = forest.trees * depth
    odd = rng.integers(0, 2**32, count, dtype=np.uint32) | np.uint32(1)
    plus = rng.integers(0, 2**32, count, dtype=np.uint32)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(forest.shingle)
        for batch in batches:
            sizes, labels, tails = [], [], []
            for text in batch["text"]:
                s = shingles.of(text, distinct=False)
                sizes.append(len(s))
                if not len(s):
                    labels.append([])
                    tails.append([])
                    continue
                least = np.full(count, np.iinfo(np.uint32).max, np.uint32)
                short = (s >> np.uint64(32)).astype(np.uint32)
                for a in range(0, len(s), 1024):
                    values = short[None, a : a + 1024] * odd[:, None] + plus[:, None]
                    np.minimum(least, values.min(1), out=least)
                path = least.astype(np.uint64).reshape(forest.trees, depth)
                label = np.arange(forest.trees, dtype=np.uint64)
                for k in range(shortest):
                    label = _mixed(label * MIX + path[:, k])
                tail = np.zeros(forest.trees, np.int64)
                for k in range(shortest, depth):
                    tail = tail << 8 | (path[:, k] & np.uint64(255)).astype(np.int64)
                labels.append(label.astype(np.int64))
                tails.append(tail)
            yield pd.DataFrame({"key": batch["key"], "size": sizes, "labels": labels, "tails": tails})

    return docs.mapInPandas(sign, "key string, size int, labels array<long>, tails array<long>")


def tries(signed: DataFrame) -> DataFrame:
    """(label, tail, key), sorted: the paths that share their shortest prefix with another text.

    Written in order of their paths, so a node's rows lie together and fold where they are read; a
    node of very many texts spreads over several ranges.
    """
    path = F.explode(F.arrays_zip("labels", "tails")).alias("path")
    flat = signed.select("key", path).select("key", "path.labels", "path.tails").toDF("key", "label", "tail")
    busy = flat.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("label")
    shared = flat.join(grown(file_stage(busy, "buckets")), "label")
    order = ["label", "tail", "key"]
    return file_stage(shared.select(*order).repartitionByRange(*order).sortWithinPartitions(*order), "tries")


def shingle_sets(docs: DataFrame, forest: Forest) -> DataFrame:
    """(key, copies, text) rows as (key, copies, n, grams): the sorted shingle hashes and their number."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(forest.shingle)
        for batch in batches:
            grams = [shingles.of(t).astype(np.int64) for t in batch["text"]]
            yield batch[["key", "copies"]].assign(n=[len(g) for g in grams], grams=grams)

    return docs.mapInPandas(cut, "key string, copies long, n long, grams array<long>")


LOOSE = 0.5  # similarity from which a text joins the group of a node's centre


def at_nodes(paths: DataFrame, roots: DataFrame, forest: Forest, length: int) -> DataFrame:
    """(label, twig, key, root, n): the texts of every node at this prefix length with their groups."""
    return paths.select(*forest.node(length), "key").join(grown(roots), "key")


def moved(roots: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """`roots` after the groups that have links to others moved to them.

    A group goes to the first of its centres' groups. The order of a round falls along these steps, so
    they make trees; two jumps lead up to four steps ahead. What is still apart then meets in the
    next round, or at last when the links are followed to their ends.
    """
    order = F.struct(F.xxhash64("other", F.lit(k)).alias("h"), "other")
    steps = file_stage(found.groupBy("root").agg(F.min(order)["other"].alias("other")), "steps")
    for _ in range(2):
        ahead = steps.select(F.col("root").alias("other"), F.col("other").alias("far"))
        steps = steps.join(grown(ahead), "other", "left").select("root", F.coalesce("far", "other").alias("other"))
    return file_stage(
        roots.join(grown(steps), "root", "left").select("key", F.coalesce("other", "root").alias("root"), "n"),
        "roots",
    )


def loose_links(paths: DataFrame, sets: DataFrame, forest: Forest) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that make loose groups, and the nodes (label, key, root, n) of the shortest prefix
    that still hold several groups.

    Prefixes are shortened round by round. In each, every node of several groups has a centre,
    another one each time, and every key is compared with the first centre of another group that its
    nodes have: as many comparisons as keys, not pairs. Centres come in one order for all nodes, so
    that near copies mostly meet the same one. Texts that share LOOSE of their shingles are linked,
    and their group moves to the centre's. What meets at a long prefix is mostly alike, so near copies
    are one group before prefixes get short, and a node of one group is not opened again; the few
    nodes that hold several groups at the shortest prefix are compared whole by `cross_links`. Texts
    of equal root are always connected by links; those of other roots may be.
    """
    right = sets.select(F.col("key").alias("centre"), F.col("grams").alias("centre_grams"))
    roots = sets.select("key", F.col("key").alias("root"), "n")
    links = []
    for k, length in enumerate(forest.lengths):
        nodes = at_nodes(paths, roots, forest, length) if links else paths.select(
            *forest.node(length), "key", F.col("key").alias("root")
        )
        order = F.struct(
            F.xxhash64("root", F.lit(k)).alias("h"), F.xxhash64("key", F.lit(k)).alias("g"), "key", "root"
        )
        centres = (
            nodes.groupBy("label", "twig")
            .agg(F.min(order).alias("first"), F.min("root").alias("low"), F.max("root").alias("high"))
            .where("low <> high")
            .select("label", "twig", "first")
        )
        pairs = (
            nodes.join(grown(centres), ["label", "twig"])
            .where("root <> first.root")
            .groupBy("key")
            .agg(F.min("first").alias("first"), F.min("root").alias("root"))
            .select("key", "root", F.col("first.key").alias("centre"), F.col("first.root").alias("other"))
        )
        met = pairs.join(grown(sets.select("key", "grams")), "key").join(grown(right), "centre")
        shared = F.size(F.array_intersect("grams", "centre_grams"))
        alike = shared / (F.size("grams") + F.size("centre_grams") - shared)
        found = file_stage(
            met.where(alike >= LOOSE).select(F.col("centre").alias("a"), F.col("key").alias("b"), "root", "other"),
            "links",
        )
        links.append(found.select("a", "b"))
        roots = moved(roots, found, k)
    nodes = at_nodes(paths, roots, forest, forest.shortest)
    state = nodes.groupBy("label", "twig").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = state.where("low <> high").select("label", "twig")
    crowded = file_stage(nodes.join(grown(mixed), ["label", "twig"]).drop("twig"), "nodes")
    # The roots join what is already linked, so that few steps lead through any group.
    own = roots.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b"))
    return reduce(DataFrame.union, links, own), crowded


# A block of a group holds about this many shingles and texts; blocks meet in pairs.
BLOCK_SHINGLES, BLOCK_TEXTS = 200_000, 256


def dealt(groups: DataFrame, sets: DataFrame, by: str) -> DataFrame:
    """`groups` with shingles in place of their number n, in meetings of two blocks (one, two) of the
    same `by`.

    A group is dealt into blocks by hash, in proportion to its size, and every pair of blocks meets.
    """
    sizes = groups.groupBy(by).agg(
        F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count(F.lit(1)) / BLOCK_TEXTS))
        .cast("int")
        .alias("blocks")
    )
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    placed = groups.join(grown(file_stage(sizes, "blocks")), by).withColumn("block", block)
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    meeting = file_stage(placed.select("*", others).drop("n"), "meetings")
    return (
        meeting.join(grown(sets.select("key", "grams")), "key")
        .withColumn("one", F.least("block", "other"))
        .withColumn("two", F.greatest("block", "other"))
        .drop("other", "blocks")
    )


def shared_shingles(grams: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """How many shingles each of `rows` shares with each text, by products of incidence matrices."""
    values, at = np.unique(np.concatenate(grams), return_inverse=True)
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    out = np.zeros((len(rows), len(grams)), np.float32)
    for low in range(0, len(values), 4096):
        a, b = np.searchsorted(at, (low, low + 4096))
        present = np.zeros((len(grams), min(4096, len(values) - low)), np.float32)
        present[owner[a:b], at[a:b] - low] = 1
        out += present[rows] @ present.T
    return out


def similar(grams: list[np.ndarray], rows: np.ndarray, threshold: float) -> np.ndarray:
    size = np.array([len(g) for g in grams], np.float64)
    shared = shared_shingles(grams, rows)
    return shared >= threshold * (size[rows, None] + size[None, :] - shared) - 1e-6


def cross_links(mixed: DataFrame, sets: DataFrame, forest: Forest) -> DataFrame:
    """(a, b): links between groups that share a node, one per text of the smaller sides."""
    threshold = forest.threshold

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", kind="stable").reset_index(drop=True)
        root, key = rows["root"].to_numpy(), rows["key"].to_numpy()
        names, count = np.unique(root, return_counts=True)
        few = np.flatnonzero(root != names[count.argmax()])
        if not len(few):
            return pd.DataFrame({"a": [], "b": []}, dtype=object)
        alike = similar([np.asarray(g) for g in rows["grams"]], few, threshold)
        alike &= root[few, None] != root[None, :]
        i, j = np.nonzero(alike)
        pairs = pd.DataFrame({"a": key[few[i]], "b": key[j], "to": root[j]})
        return pairs.drop_duplicates(["a", "to"])[["a", "b"]]

    return dealt(mixed, sets, "label").groupBy("label", "one", "two").applyInPandas(
        compare, "a string, b string"
    )


def verified(groups: DataFrame, sets: DataFrame, forest: Forest) -> DataFrame:
    """(key, links, near) per text and meeting of blocks of its group: how many documents of other
    texts are similar to it there, and the smallest text that it is connected to.

    `groups` is (key, root, copies, n). Every meeting is one task group that compares all its texts
    exactly and emits one row per text, never one per pair.
    """
    threshold = forest.threshold

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", kind="stable").reset_index(drop=True)
        every = np.arange(len(rows))
        alike = similar([np.asarray(g) for g in rows["grams"]], every, threshold)
        block = rows["block"].to_numpy()
        if rows["one"].iloc[0] != rows["two"].iloc[0]:  # a block's own pairs count where it meets itself
            alike &= block[:, None] != block[None, :]
        np.fill_diagonal(alike, False)
        links = alike @ rows["copies"].to_numpy().astype(np.int64)
        near = every.copy()
        while True:
            heard = np.where(alike, near[None, :], len(rows)).min(1)
            new = np.minimum(near, heard)
            new = new[new]
            if (new == near).all():
                break
            near = new
        keys = rows["key"].to_numpy()
        return pd.DataFrame({"key": keys, "links": links.astype("int64"), "near": keys[near]})

    return dealt(groups, sets, "root").groupBy("root", "one", "two").applyInPandas(
        compare, "key string, links long, near string"
    )


def similar_texts(df: DataFrame, forest: Forest, id_col: str, text_col: str) -> DataFrame:
    """One row per different text: key (its digest), first (smallest id), copies, root (digest that
    names the class, null for a text without words), links (documents of other, similar texts)."""
    key = F.md5(text_of(text_col))
    rows = df.select(key.alias("key"), col(id_col).alias("id"), text_of(text_col).alias("text"))
    copies = file_stage(
        df.select(key.alias("key"), col(id_col).alias("id")).groupBy("key").agg(
            F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")
        ),
        "copies",
    )
    signed = file_stage(signatures(rows.select("key", "text"), forest).dropDuplicates(["key"]), "signatures")
    members = tries(signed)
    # One row per text: copies differ in their id, so a text with many copies is read from many places.
    wanted = members.select("key").distinct().join(grown(copies), "key")
    named = grown(file_stage(wanted.select(F.col("key").alias("of"), "first", "copies"), "wanted"))
    single = rows.join(named, (F.col("key") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")))
    sets = file_stage(
        shingle_sets(single.select("key", "copies", "text"), forest).dropDuplicates(["key"]), "sets"
    )
    edges, mixed = loose_links(members, sets, forest)
    if not mixed.isEmpty():
        edges = edges.union(file_stage(cross_links(mixed, sets, forest), "across"))
    loose = components(edges)
    known = sets.select("key", "copies", "n")
    groups = file_stage(
        loose.withColumnRenamed("id", "key").join(grown(known), "key").select("key", "root", "copies", "n"),
        "groups",
    )
    checked = file_stage(verified(groups, sets, forest), "checked")
    links = checked.groupBy("key").agg(F.sum("links").alias("links"))
    classes = components(checked.select(F.col("key").alias("a"), F.col("near").alias("b")))
    found = links.join(grown(classes.withColumnRenamed("id", "key")), "key", "left")
    texts = copies.join(grown(signed.select("key", "size")), "key").join(grown(found), "key", "left")
    return texts.select(
        "key",
        "first",
        "copies",
        F.when(F.col("size") > 0, F.coalesce("root", "key")).alias("root"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )


def near_duplicates(
    df: DataFrame, forest: Forest | None = None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`df` with `class_id` (smallest id of the class) and `links` (other documents of which at least
    `threshold` of the shingles are shared, copies counted one by one).

    Equal texts are one node of the graph and are never expanded into pairs. Classes are the
    connected components of exact links between texts. Null, empty and blank texts have no shingles:
    each is a class of its own with its own id and no links. Ids that are null never name a class
    that has another id. Repeated rows are copies like any others. Columns named class_id or links
    are replaced, all others stay.
    """
    forest = forest or Forest()
    kept = without(df, ("class_id", "links"))
    texts = file_stage(similar_texts(df, forest, id_col, text_col), "texts")
    ids = texts.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("class_id"))
    mark, of, root, copies, named_class, near_links = free_names(
        df, "_key", "_of", "_root", "_copies", "_class", "_links"
    )
    named = file_stage(
        texts.join(grown(ids), "root", "left").select(
            F.col("key").alias(of),
            F.col("root").alias(root),
            F.col("class_id").alias(named_class),
            F.col("copies").alias(copies),
            F.col("links").alias(near_links),
        ),
        "named",
    )
    rows = df.select(*kept, F.md5(text_of(text_col)).alias(mark))
    blank = col(root).isNull()
    return rows.join(grown(named), col(mark) == col(of), "left").select(
        *kept,
        F.when(blank, col(id_col)).otherwise(col(named_class)).alias("class_id"),
        F.when(blank, F.lit(0)).otherwise(col(near_links) + col(copies) - 1).cast("long").alias("links"),
    )


def keep_one(
    df: DataFrame, forest: Forest | None = None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`df` with one row of each class of near duplicates: the one of the smallest id.

    Texts without words stay, all of them. Rows that repeat that id are further told apart by their
    text; of wholly equal ones any one stays.
    """
    texts = similar_texts(df, forest or Forest(), id_col, text_col)
    best = texts.where("root IS NOT NULL").groupBy("root").agg(
        F.min(F.struct(F.col("first").isNull(), F.col("first"), F.col("key"))).alias("best")
    )
    mark, of, first = free_names(df, "_key", "_of", "_first")
    chosen = best.select(F.col("best.key").alias(of), F.col("best.first").alias(first))
    kept = file_stage(chosen, "kept")
    worded = text_of(text_col).rlike(WORD)
    names = [col(c) for c in df.columns]
    # Copies of a text differ in their id, so they meet their class in different places.
    same = (col(mark) == col(of)) & col(id_col).eqNullSafe(col(first))
    only = df.where(worded).withColumn(mark, F.md5(text_of(text_col))).join(grown(kept), same)
    return only.dropDuplicates([mark]).select(*names).unionByName(df.where(~worded).select(*names))


def op6_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates and the number of links of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "links")
