"""Document quality: random-indexing word vectors, pooled, in a two-layer calibrated network."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, table, text_of, without
from .labelled import learning_sample, one_per_group, sigmoid
from .toxicity import grouped

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
BUCKETS = 1 << 14  # hashed vocabulary; rarer words share a bucket
SIZE = 32  # numbers of a word vector
REACH = 2  # neighbours on each side
CACHE = 400_000  # words whose bucket a task remembers

# The bounded sample that the network is fitted on.
PER_CLASS, MAX_CHARS, SEED = 3_000, 12_000, 11


def _index() -> tuple[np.ndarray, np.ndarray]:
    """Index vectors: per bucket two places and their signs, from a fixed seed."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, SIZE, (BUCKETS, 2)), rng.choice([-1, 1], (BUCKETS, 2))


PLACES, SIGNS = _index()


class Buckets(dict):
    def __missing__(self, word: str) -> int:
        at = self[word] = zlib.crc32(word.encode()) & (BUCKETS - 1)
        return at


class Reader:
    """Texts as bucket numbers."""

    def __init__(self) -> None:
        self.known = Buckets()

    def read(self, text: str) -> np.ndarray:
        if len(self.known) > CACHE:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, TOKEN.findall(text)), np.int64)


def neighbours(ids: np.ndarray, gaps: np.ndarray, into: np.ndarray) -> None:
    """Adds to `into` (bucket x number) the index vectors around every token.

    `ids` are the tokens of several texts, `gaps` the places where a text begins; no window crosses
    one. Sums are whole numbers, so their order doesn't matter.
    """
    text = np.zeros(len(ids), np.int64)
    text[gaps[gaps < len(ids)]] = 1
    text = np.cumsum(text)
    flat = into.reshape(-1)
    for step in range(1, REACH + 1):
        same = np.flatnonzero(text[step:] == text[:-step])
        left, right = ids[same], ids[same + step]
        for a, b in ((left, right), (right, left)):
            for k in (0, 1):
                flat += np.bincount(
                    a * SIZE + PLACES[b, k], SIGNS[b, k], minlength=flat.size
                ).astype(np.int64)


def context_sums(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Context vectors of all buckets over all documents.

    Each task sums its own texts into one table of BUCKETS x SIZE whole numbers and emits its used
    rows; Spark adds them up by bucket. What reaches the driver is that table, whatever the input.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, total = Reader(), np.zeros((BUCKETS, SIZE), np.int64)
        for batch in batches:
            texts = list(batch["text"])
            for a, b in grouped(texts):
                ids = [reader.read(t) for t in texts[a:b]]
                lengths = np.array([len(i) for i in ids])
                if lengths.sum():
                    neighbours(np.concatenate(ids), np.cumsum(lengths)[:-1], total)
        used = np.flatnonzero(np.abs(total).sum(1))
        out = pd.DataFrame(total[used], columns=[f"c{i}" for i in range(SIZE)])
        out.insert(0, "bucket", used)
        yield out

    names = [f"c{i}" for i in range(SIZE)]
    schema = "bucket long, " + ", ".join(f"{n} long" for n in names)
    parts = docs.select(text_of(text_col).alias("text")).mapInPandas(sums, schema)
    rows = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    out = np.zeros((BUCKETS, SIZE))
    if len(rows):
        out[rows["bucket"].to_numpy()] = rows[names].to_numpy()
    return out


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit context vector of each bucket beside its own index vector."""
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    own = np.zeros((BUCKETS, SIZE))
    for k in (0, 1):
        np.add.at(own, (np.arange(BUCKETS), PLACES[:, k]), SIGNS[:, k] / np.sqrt(2))
    return np.hstack([sums / np.maximum(norm, 1.0), own])


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """One vector per document: mean and spread of its word vectors, how alike neighbours and the
    whole are, and its length."""
    width = vectors.shape[1]
    if not len(ids):
        return np.zeros(2 * width + 4)
    used, count = np.unique(ids, return_counts=True)
    weight = count / len(ids)
    rows = vectors[used]
    mean = weight @ rows
    spread = np.sqrt(np.maximum(weight @ rows**2 - mean**2, 0.0))
    alike = float((ids[1:] == ids[:-1]).mean()) if len(ids) > 1 else 0.0
    return np.concatenate(
        [mean, spread, [alike, float((weight**2).sum()), len(used) / len(ids), np.log1p(len(ids))]]
    )


@dataclass(frozen=True)
class Network:
    """Standardisation, two layers and the temperature of the output."""

    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        return np.tanh(z @ self.hidden + self.hidden_bias) @ self.out + self.out_bias

    def chance(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def fit_network(
    x: np.ndarray, y: np.ndarray, vectors: np.ndarray, prior: float, units: int = 24
) -> Network:
    """Adam on the logistic loss; one row in five is kept for stopping and for the temperature.

    Classes are weighted so that label 1 has the share `prior` it has among all labelled rows.
    """
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    check, learn = order[: len(y) // 5], order[len(y) // 5 :]
    centre, scale = x[learn].mean(0), x[learn].std(0) + 1e-3
    wide = x.shape[1]
    p = [
        rng.normal(0, 1 / np.sqrt(wide), (wide, units)),
        np.zeros(units),
        rng.normal(0, 1 / np.sqrt(units), units),
        np.zeros(1),
    ]
    share = y.mean()
    weight = np.where(y == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    z = np.clip((x - centre) / scale, -6, 6)

    def logits(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(z[rows] @ p[0] + p[1])
        return h @ p[2] + p[3][0], h

    def loss(t: np.ndarray, rows: np.ndarray, heat: float = 1.0) -> float:
        s = t / heat
        each = np.logaddexp(0, s) - y[rows] * s
        return float((each * weight[rows]).sum() / weight[rows].sum())

    best, kept, step, stale = np.inf, [a.copy() for a in p], 0, 0
    for _ in range(200):
        for a in range(0, len(learn), 128):
            rows = learn[a : a + 128]
            t, h = logits(rows)
            d = (sigmoid(t) - y[rows]) * weight[rows] / len(rows)
            back = np.outer(d, p[2]) * (1 - h * h)
            grads = [z[rows].T @ back + 1e-4 * p[0], back.sum(0), h.T @ d + 1e-4 * p[2], d.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] -= 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        now = loss(logits(check)[0], check) if len(check) else 0.0
        if now < best - 1e-5:
            best, kept, stale = now, [a.copy() for a in p], 0
        else:
            stale += 1
            if stale >= 15:
                break
    p = kept
    heats = np.geomspace(0.25, 6, 60)
    t = logits(check)[0] if len(check) else np.zeros(0)
    heat = float(min(heats, key=lambda h: loss(t, check, h))) if len(check) else 1.0
    return Network(vectors, centre, scale, p[0], p[1], p[2], float(p[3][0]), heat)


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> Network:
    """Word vectors from all documents; the network from a bounded sample of labelled rows that are
    not held out (about PER_CLASS per label, of MAX_CHARS characters at most).

    Labels of one class only, or none, give that class's share as the score of every document.
    """
    vectors = word_vectors(context_sums(docs, text_col))
    rows = one_per_group(
        learning_sample(
            docs,
            labels,
            "quality",
            per_class=PER_CLASS,
            max_chars=MAX_CHARS,
            seed=SEED,
            id_col=id_col,
            text_col=text_col,
        )
    )
    reader = Reader()
    wide = 2 * vectors.shape[1] + 4
    x = np.array([pooled(reader.read(t), vectors) for t in rows["text"]]).reshape(-1, wide)
    y = rows["label"].to_numpy(float)
    learnt = labels.where(~held_out(F.col(id_col)) & F.col("quality").isin(0, 1))
    prior = learnt.agg(F.avg("quality")).first()[0]
    if not len(y) or y.min() == y.max():
        share = min(max(0.5 if prior is None else prior, 0.01), 0.99)
        bias = float(np.log(share / (1 - share)))
        zero = np.zeros((wide, 1))
        return Network(vectors, np.zeros(wide), np.ones(wide), zero, np.zeros(1), np.zeros(1), bias)
    return fit_network(x, y, vectors, prior)


def score_quality(df: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """`df` with `score`, the calibrated chance that the document is of good quality.

    Whole texts are pooled; null and empty texts are the zero vector, scored like any other. Rows are
    scored on their own in Arrow batches, so repeated rows score alike; a column named score is
    replaced, others stay.
    """
    shared = df.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf(T.DoubleType())
    def apply(texts: pd.Series) -> pd.Series:
        reader = Reader()
        rows = np.array([pooled(reader.read(t), shared.value.vectors) for t in texts])
        return pd.Series(shared.value.chance(rows) if len(rows) else [], dtype="float64")

    return df.select(*without(df, ["score"]), apply(text_of(text_col)).alias("score"))


THRESHOLD = 0.7


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of query 8."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, network).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
