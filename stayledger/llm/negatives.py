"""Hard negatives by exact integer scores from float32 products in a residue number system.

Components are reduced modulo several small primes, each residue matrix is multiplied in float32
without rounding, and Chinese remaindering gives the signed score back. Anchors stay in a task while
rows stream past them in blocks; a task keeps only the best candidates of each anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, file_stage

EVERY = 100  # ids divisible by it are anchors
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH, WHOLE = 30, 90, 100  # window of a negative's score, in parts of the positive's
SCALE = 256

DEPTH = 1024  # components of one float32 product
EXACT = 1 << 23  # a product's residues and their differences stay below 2 ** 24
ANCHORS_PER_CELL = 1 << 16
ROWS_PER_CELL = 1 << 20
LEAST_ROWS = 1024  # rows worth a cell of their own
BLOCK = 256  # anchors scored at once


def choose_primes(dims: int, bound: int) -> list[int]:
    """The largest primes whose residue products are exact in float32, until their product holds
    every score of magnitude `bound` at most."""
    half = int((EXACT / max(1, min(dims, DEPTH))) ** 0.5)
    out, product, p = [], 1, 2 * min(half, 1 << 11) + 1
    while product <= 2 * bound + 1:
        while any(p % d == 0 for d in range(2, int(p**0.5) + 1)):
            p -= 1
        if p < 3:
            raise ValueError(f"no residue system for scores up to {bound}")
        half_range = (p - 1) // 2
        if half_range * half_range * max(1, min(dims, DEPTH)) < EXACT:
            out.append(p)
            product *= p
        p -= 1
    return out


def _centred(u: np.ndarray, p: int) -> np.ndarray:
    """Residues in -(p-1)/2 to (p-1)/2, in place; two rounds, as the first quotient is rounded."""
    for _ in range(2):
        u -= p * np.rint(u * np.float32(1 / p))
    return u


class Residues:
    """Rows of integer vectors, reduced modulo each prime and ready for products."""

    def __init__(self, values: np.ndarray, primes: list[int]) -> None:
        self.primes = primes
        self.parts = []
        for p in primes:
            r = np.fmod(values, p)
            half = (p - 1) // 2
            r = np.where(r > half, r - p, np.where(r < -half, r + p, r))
            self.parts.append(np.ascontiguousarray(r, np.float32))

    def scores(self, others: Residues, first: int, last: int) -> np.ndarray:
        """Exact inner products of rows `first` to `last` with all `others`."""
        digits: list[np.ndarray] = []
        for j, p in enumerate(self.primes):
            mine, other = self.parts[j][first:last], others.parts[j]
            u = np.zeros((len(mine), len(other)), np.float32)
            for k in range(0, max(1, mine.shape[1]), DEPTH):
                u += _centred(mine[:, k : k + DEPTH] @ other[:, k : k + DEPTH].T, p)
            u = _centred(u, p)
            for i, t in enumerate(digits):  # the digit of the mixed radix
                inverse = pow(self.primes[i], -1, p)
                inverse -= p if inverse > p // 2 else 0
                u -= t
                u *= np.float32(inverse)
                u = _centred(u, p)
            digits.append(u)
        small = int(np.prod([float(p) for p in self.primes])) < 1 << 24
        kind = np.float32 if small else np.int64
        out = digits[-1].astype(kind)
        for t, p in zip(reversed(digits[:-1]), reversed(self.primes[:-1]), strict=True):
            out *= kind(p)
            out += t.astype(kind)
        return out


def matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    """floor(SCALE * x) as whole doubles, shorter vectors filled with 0; magnitudes that could push
    a score out of a long are held at the largest that cannot."""
    out = np.zeros((len(vectors), dims))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    with np.errstate(over="ignore"):
        out = np.floor(out * SCALE)
    return np.clip(out, -ceiling(dims), ceiling(dims))


def ceiling(dims: int) -> float:
    return float(int(((1 << 62) / max(1, dims)) ** 0.5))


class Best:
    """The k best (score, id) of each slot, higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int) -> None:
        self.k = k
        self.score = np.full((slots, k), np.iinfo(np.int64).min)
        self.id = np.full((slots, k), np.iinfo(np.int64).max)

    def floor(self) -> np.ndarray:
        return self.score[:, -1]

    def offer(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        worst, last = self.score[slot, -1], self.id[slot, -1]
        better = (score > worst) | ((score == worst) & (ident < last))
        slot, score, ident = slot[better], score[better], ident[better]
        if not slot.size:
            return
        met = np.unique(slot)
        slot = np.r_[np.repeat(met, self.k), slot]
        score = np.r_[self.score[met].ravel(), score]
        ident = np.r_[self.id[met].ravel(), ident]
        order = np.lexsort((ident, -score, slot))  # scores stay above -2 ** 63 or mark an empty place
        filled = score[order] != np.iinfo(np.int64).min
        order = np.r_[order[filled], order[~filled]]
        order = order[np.argsort(slot[order], kind="stable")]
        slot = slot[order]
        starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        take = (starts[:, None] + np.arange(self.k)).ravel()
        self.score[met] = score[order][take].reshape(-1, self.k)
        self.id[met] = ident[order][take].reshape(-1, self.k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(self.score != np.iinfo(np.int64).min)
        return slot, self.score[slot, place], self.id[slot, place]


class PositiveSearch:
    """The best other rows of an anchor's label."""

    schema = "anchor_id long, id long, score long"

    def __init__(self, anchors: pd.DataFrame) -> None:
        self.ids = anchors["id"].to_numpy(np.int64)
        self.labels = anchors["label"].to_numpy(np.int64)
        self.best = Best(len(anchors), POSITIVES)

    def see(self, first: int, last: int, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        wanted = scores >= self.best.floor()[first:last, None].astype(scores.dtype)
        wanted &= self.labels[first:last, None] == labels
        a, r = np.nonzero(wanted)
        other = self.ids[first + a] != ids[r]
        a, r = a[other], r[other]
        self.best.offer(first + a, scores[a, r].astype(np.int64), ids[r])

    def found(self) -> pd.DataFrame:
        slot, score, ident = self.best.rows()
        return pd.DataFrame({"anchor_id": self.ids[slot], "id": ident, "score": score})


class NegativeSearch:
    """The best rows of another label inside the window of each positive."""

    schema = (
        "anchor_id long, place int, positive_id long, positive_score long, id long, score long"
    )

    def __init__(self, anchors: pd.DataFrame) -> None:
        self.ids = anchors["id"].to_numpy(np.int64)
        self.labels = anchors["label"].to_numpy(np.int64)
        none = np.iinfo(np.int64)
        shape = (len(anchors), POSITIVES)
        self.low = np.full(shape, none.max)
        self.high = np.full(shape, none.min)
        self.positive = np.zeros((*shape, 2), np.int64)
        for k, positives in enumerate(anchors["positives"]):
            for w, one in enumerate(positives):
                whole, rest = divmod(int(one["score"]), WHOLE)
                self.positive[k, w] = one["id"], one["score"]
                self.low[k, w] = LOW * whole - (-LOW * rest) // WHOLE
                self.high[k, w] = HIGH * whole + HIGH * rest // WHOLE
        self.best = Best(len(anchors) * POSITIVES, NEGATIVES)

    def see(self, first: int, last: int, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        least = np.maximum(self.low, self.best.floor().reshape(self.low.shape))[first:last]
        most = self.high[first:last]
        # Limits are compared in the scores' own type, where those of real windows are exact.
        wide = scores.dtype.type
        wanted = scores >= least.min(axis=1).astype(wide)[:, None]
        wanted &= scores <= most.max(axis=1).astype(wide)[:, None]
        wanted &= self.labels[first:last, None] != labels
        a, r = np.nonzero(wanted)
        s = scores[a, r].astype(np.int64)
        for w in range(POSITIVES):
            inside = (s >= least[a, w]) & (s <= most[a, w])
            self.best.offer((first + a[inside]) * POSITIVES + w, s[inside], ids[r[inside]])

    def found(self) -> pd.DataFrame:
        slot, score, ident = self.best.rows()
        anchor, place = slot // POSITIVES, slot % POSITIVES
        return pd.DataFrame(
            {
                "anchor_id": self.ids[anchor],
                "place": place.astype(np.int32),
                "positive_id": self.positive[anchor, place, 0],
                "positive_score": self.positive[anchor, place, 1],
                "id": ident,
                "score": score,
            }
        )


def search(
    rows: DataFrame, anchors: DataFrame, kind: type, dims: int, primes: list[int], cells: tuple[int, int]
) -> DataFrame:
    """What `kind` finds for every anchor in every part of the rows.

    Anchors are dealt to groups and rows to parts; a cell is one group and one part, and its task
    reads the group first and then the rows, batch by batch.
    """
    groups, parts = cells
    part = F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int")
    group = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select("*", group.alias("g"), every(parts).alias("r"), F.lit(0).alias("kind"))
    right = rows.select("*", every(groups).alias("g"), part.alias("r"), F.lit(1).alias("kind"))
    stream = left.unionByName(right, allowMissingColumns=True)

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, waiting, task, residues = None, [], None, None
        for batch in batches:
            spot = batch[["g", "r", "kind"]].to_numpy(np.int64)
            starts = np.flatnonzero(np.r_[True, (spot[1:] != spot[:-1]).any(axis=1)])
            for start, end in zip(starts, np.r_[starts[1:], len(batch)], strict=True):
                own = batch.iloc[start:end]
                if own.empty:
                    continue
                if tuple(spot[start, :2]) != cell:
                    if task is not None:
                        yield task.found()
                    cell, waiting, task = tuple(spot[start, :2]), [], None
                if spot[start, 2] == 0:
                    waiting.append(own)
                    continue
                if task is None:
                    if not waiting:  # a part of the rows that meets no anchor
                        continue
                    held = pd.concat(waiting, ignore_index=True)
                    task = kind(held)
                    residues = Residues(matrix(held["v"], dims), primes)
                others = Residues(matrix(own["v"], dims), primes)
                ids, labels = own["id"].to_numpy(np.int64), own["label"].to_numpy(np.int64)
                for first in range(0, len(task.ids), BLOCK):
                    last = min(first + BLOCK, len(task.ids))
                    task.see(first, last, residues.scores(others, first, last), ids, labels)
        if task is not None:
            yield task.found()

    dealt = stream.repartition("g", "r").sortWithinPartitions("g", "r", "kind")
    return dealt.mapInPandas(answer, kind.schema)


def first_rows(found: DataFrame, keys: list[str], most: int, out: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn(out, F.row_number().over(order)).where(F.col(out) <= most)


def mine(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    every: int = EVERY,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by `every`; the score of a row is its exact inner
    product with the anchor over floor(SCALE * x). Rows with a null id, label, vector or component,
    or a component that is not finite, take no part. Of anchors with equal id the smallest (label,
    vector) is one; any other repeated row is a candidate of its own, and rows with the anchor's id
    are never its positives. Vectors of unequal length count as filled with zeros; a component so
    large that a score could leave a long is held at the largest that cannot. Ties go to the
    smaller id. An empty table, or one without anchors, gives no rows; other columns are ignored.
    """
    bad = F.exists(col(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = df.select(
        col(id_col).cast("long").alias("id"),
        col(label_col).cast("long").alias("label"),
        col(vector_col).alias("v"),
        bad.alias("bad"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.col("bad"))
    rows = rows.drop("bad")
    anchors = file_stage(
        rows.where(F.col("id") % every == 0)
        .groupBy("id")
        .agg(F.min(F.struct("label", "v")).alias("one"))
        .select("id", "one.label", "one.v"),
        "anchors",
    )
    length = F.aggregate(
        "v", F.lit(0.0), lambda acc, x: acc + F.pow(F.abs(x.cast("double")) * SCALE + 1, 2)
    )
    n, dims, square = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(length)).first()
    n_anchors = anchors.count()
    dims = max(1, dims or 0)
    # |score| <= the product of two lengths, and never more than clipped components can make.
    bound = int(min((square or 0.0) * (1 + 1e-9) + 1, dims * ceiling(dims) ** 2))
    primes = choose_primes(dims, bound)
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(n // ROWS_PER_CELL + 1, min(wanted, n // LEAST_ROWS + 1))
    cells = (n_anchors // ANCHORS_PER_CELL + 1, parts)

    near = search(rows, anchors, PositiveSearch, dims, primes, cells)
    positives = (
        first_rows(near, ["anchor_id"], POSITIVES, "place")
        .groupBy(F.col("anchor_id").alias("id"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("positives"))
    )
    wanted_anchors = file_stage(anchors.join(positives, "id"), "windows")
    hard = search(rows, wanted_anchors, NegativeSearch, dims, primes, cells)
    ranked = first_rows(hard, ["anchor_id", "place"], NEGATIVES, "rank")
    return ranked.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of query 13."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", flipped))


ORACLE = f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, r.vec_id AS id, r.label,
  CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM e a JOIN e r ON a.vec_id % {EVERY} = 0),
positives AS (SELECT anchor_id, own, id AS positive_id, score AS positive_score FROM s
  WHERE label = own AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}),
inside AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM positives p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own
    AND {LOW} * positive_score <= {WHOLE} * s.score AND {WHOLE} * s.score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM inside WHERE rank <= {NEGATIVES}"""
