"""Toxic spans by a linear-chain conditional random field, aggregated to document scores."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, free_names, held_out, table, text_of, without
from .labelled import learning_sample, logistic, one_per_group, sigmoid

TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
ENDS = frozenset(".!?\n")
CHAIN = 64  # tokens of one chain; a longer sentence goes on in a chain of its own
SLOTS = 1 << 18  # hashed feature weights
DOUBT = 0.3  # chance from which a token counts
CACHE = 400_000  # words whose emissions a task remembers

# The bounded sample that the field is fitted on.
PER_CLASS, MAX_CHARS, SEED = 2_500, 8_000, 5


def slot(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}={value}".encode()) & (SLOTS - 1)


def own_features(word: str) -> list[int]:
    """Feature places of a token: the word, its beginnings, its end and its shape."""
    low = word.lower()
    shape = "A" if word.isupper() and len(word) > 1 else "a" if word.islower() else "Aa"
    out = [slot("w", low), slot("s3", low[-3:]), slot("shape", shape)]
    return out + [slot(f"p{n}", low[:n]) for n in (3, 4, 5, 6) if len(low) >= n]


def evidence(word: str) -> list[str]:
    """Properties of a word whose documents are counted by label."""
    low = word.lower()
    return [f"w={low}"] + [f"p{n}={low[:n]}" for n in (4, 5, 6) if len(low) >= n]


@dataclass(frozen=True)
class Field:
    """Emission weights (toxic against clean) by feature place, transitions, document calibration."""

    weights: np.ndarray
    before: np.ndarray
    after: np.ndarray
    steps: np.ndarray  # 2 x 2, from row to column; state 1 is toxic
    start: np.ndarray
    calibration: np.ndarray


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text)


def token_labels(rows: pd.DataFrame) -> dict[str, bool]:
    """Which words of the sample are toxic, from document labels alone.

    A word is toxic if the word or one of its beginnings is met in toxic documents far more often
    than chance has it (log-likelihood ratio), and hardly ever in clean ones.
    """
    seen = {0: Counter(), 1: Counter()}
    words: set[str] = set()
    for text, label in zip(rows["text"], rows["label"], strict=True):
        own = {w for w in tokens(text) if w not in ENDS}
        words |= own
        seen[label].update({e for w in own for e in evidence(w)})
    docs = {k: max(1, int((rows["label"] == k).sum())) for k in (0, 1)}
    base = docs[1] / (docs[0] + docs[1])
    marked = set()
    for item, hits in seen[1].items():
        misses = seen[0][item]
        rate = hits / (hits + misses)
        if hits < 4 or rate <= max(0.9, base):
            continue
        ratio = hits * math.log(rate / base)
        if misses:
            ratio += misses * math.log((1 - rate) / (1 - base))
        if 2 * ratio >= 24 and hits / docs[1] >= 0.002:
            marked.add(item)
    return {w: any(e in marked for e in evidence(w)) for w in words}


def chains(lengths: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and size of every chain over the joined tokens of several texts.

    A chain ends before a sentence mark, at the end of its text, and after CHAIN tokens.
    """
    total = int(lengths.sum())
    cut = np.zeros(total + 1, bool)
    cut[0] = cut[total] = True
    cut[np.cumsum(lengths)] = True
    marks = np.flatnonzero(ends)
    cut[marks] = True
    cut[marks + 1] = True
    edge = np.flatnonzero(cut)
    first, size = edge[:-1], np.diff(edge)
    parts = -(-size // CHAIN)
    base = np.repeat(first, parts)
    part = np.arange(len(base)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = base + part * CHAIN
    stop = np.minimum(start + CHAIN, np.repeat(first + size, parts))
    keep = ~ends[start] if total else np.zeros(0, bool)
    return start[keep], (stop - start)[keep]


def forward_backward(
    emit: np.ndarray, size: np.ndarray, steps: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chance of the toxic state per token, expected transitions, log partition per chain.

    `emit` is chains x longest: the score of toxic against clean. Messages are scaled at each step.
    """
    n, longest = emit.shape
    odds = np.exp(np.clip(emit, -30, 30))
    move = np.exp(steps)
    ahead = np.empty((longest, n, 2))
    log_z = np.zeros(n)
    now = np.repeat(np.exp(start)[None, :], n, 0)
    for t in range(longest):
        if t:
            now = ahead[t - 1] @ move
        live = (t < size).astype(float)
        now = np.stack([now[:, 0], now[:, 1] * odds[:, t]], 1)
        scale = now.sum(1)
        ahead[t] = now / scale[:, None]
        log_z += np.log(scale) * live
    chance = np.zeros((n, longest))
    pairs = np.zeros((2, 2))
    back = np.ones((n, 2))
    for t in range(longest - 1, -1, -1):
        last = t >= size - 1
        back = np.where(last[:, None], 1.0, back)
        joint = ahead[t] * back
        total = joint.sum(1)
        chance[:, t] = joint[:, 1] / total * (t < size)
        if t:
            heard = np.stack([back[:, 0], back[:, 1] * odds[:, t]], 1)
            both = ahead[t - 1][:, :, None] * move[None] * heard[:, None, :]
            weight = ((t < size) / both.sum((1, 2)))[:, None, None]
            pairs += (both * weight).sum(0)
            back = heard @ move.T
            back /= back.sum(1)[:, None]
    return chance, pairs, log_z


def padded(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the chains side by side, and where each came from (-1 for padding)."""
    at = start[:, None] + np.arange(int(size.max()))[None, :]
    real = np.arange(at.shape[1])[None, :] < size[:, None]
    return np.where(real, flat[np.where(real, at, 0)], 0.0), np.where(real, at, -1)


def fit_field(rows: pd.DataFrame, epochs: int = 6, rate: float = 0.25, batch: int = 512) -> Field:
    """The field for a labelled sample, by adaptive gradient steps on the chains' likelihood."""
    toxic = token_labels(rows)
    # Tokens become numbers text by text: as strings, all of them together fill the driver.
    vocabulary: dict[str, int] = defaultdict(itertools.count().__next__)
    texts = [np.fromiter(map(vocabulary.__getitem__, tokens(t)), np.int32) for t in rows["text"]]
    lengths = np.array([len(t) for t in texts], int)
    if not vocabulary:
        zero = np.zeros(SLOTS)
        return Field(zero, zero, zero, np.zeros((2, 2)), np.zeros(2), np.array([0.0, 0.0, -3.0]))
    ids = np.concatenate(texts)
    del texts
    widest = 7
    feats = np.full((len(vocabulary) + 1, widest), SLOTS)
    for w, i in vocabulary.items():
        places = own_features(w)
        feats[i, : len(places)] = places
    context = np.array([slot("w", w.lower()) for w in vocabulary] + [SLOTS])
    label = np.array([toxic.get(w, False) for w in vocabulary])[ids]
    ends = np.array([w in ENDS for w in vocabulary])[ids]
    start, size = chains(lengths, ends)
    if not len(start):
        zero = np.zeros(SLOTS)
        return Field(zero, zero, zero, np.zeros((2, 2)), np.zeros(2), np.array([0.0, 0.0, -3.0]))

    w = {k: np.zeros(SLOTS + 1) for k in ("own", "before", "after")}
    g2 = {k: np.full(SLOTS + 1, 1e-2) for k in w}
    steps, steps2 = np.zeros((2, 2)), np.full((2, 2), 1e-2)
    first, first2 = np.zeros(2), np.full(2, 1e-2)
    rng = np.random.default_rng(SEED)
    # Every chain with a toxic token, and as many others, in each epoch a new draw of them.
    hot = np.add.reduceat(label, start) if len(start) else np.zeros(0)
    with_toxic = np.flatnonzero(hot > 0)
    others = np.flatnonzero(hot == 0)
    for _ in range(epochs):
        drawn = rng.permutation(others)[: max(4_000, 3 * len(with_toxic))]
        order = rng.permutation(np.concatenate([with_toxic, drawn]))
        for a in range(0, len(order), batch):
            pick = order[a : a + batch]
            s, z = start[pick], size[pick]
            _, at = padded(label, s, z)
            real = at >= 0
            own = np.where(real, ids[np.where(real, at, 0)], len(vocabulary))
            prev = np.hstack([np.full((len(pick), 1), len(vocabulary)), own[:, :-1]])
            follow = np.hstack([own[:, 1:], np.full((len(pick), 1), len(vocabulary))])
            emit = (
                w["own"][feats[own]].sum(2)
                + w["before"][context[prev]]
                + w["after"][context[follow]]
            )
            y = np.where(real, label[np.where(real, at, 0)], 0.0)
            chance, pairs, _ = forward_backward(emit, z, steps, first)
            miss = np.where(real, chance - y, 0.0)
            grads = {
                "own": np.bincount(
                    feats[own].ravel(), np.repeat(miss.ravel(), widest), minlength=SLOTS + 1
                ),
                "before": np.bincount(context[prev].ravel(), miss.ravel(), minlength=SLOTS + 1),
                "after": np.bincount(context[follow].ravel(), miss.ravel(), minlength=SLOTS + 1),
            }
            for k, g in grads.items():
                g = g / len(pick) + 1e-6 * w[k]
                g2[k] += g * g
                w[k] -= rate * g / np.sqrt(g2[k])
                w[k][SLOTS] = 0.0
            seen = np.zeros((2, 2))
            both = real[:, 1:]
            for i in (0, 1):
                for j in (0, 1):
                    seen[i, j] = ((y[:, :-1] == i) & (y[:, 1:] == j) & both).sum()
            g = (pairs - seen) / len(pick)
            steps2 += g * g
            steps -= rate * g / np.sqrt(steps2)
            y0, c0 = y[:, 0].mean(), chance[:, 0].mean()
            g = np.array([y0 - c0, c0 - y0])
            first2 += g * g
            first -= rate * g / np.sqrt(first2)
    field = Field(w["own"], w["before"], w["after"], steps, first, np.zeros(3))
    scorer, whole = Scorer(field), list(rows["text"])
    hits = (c for a, b in grouped(whole, 500_000) for c in scorer.chances(whole[a:b]))
    x = np.array([summary(c) for c in hits])
    return Field(w["own"], w["before"], w["after"], steps, first, logistic(x, rows["label"].to_numpy(float)))


def summary(chance: np.ndarray) -> tuple[float, float]:
    """What the document score reads: the expected number of toxic tokens among those in doubt or
    beyond, and the surest one. The floor keeps a long clean text from adding up to a toxic one."""
    if not len(chance):
        return 0.0, 0.0
    return math.log1p(float(chance[chance >= DOUBT].sum())), float(chance.max())


def toxic_chances(
    emit: np.ndarray, size: np.ndarray, steps: np.ndarray, start: np.ndarray
) -> np.ndarray:
    """The chances of `forward_backward` alone. `emit` is place x chain; the two states are carried
    as one ratio of toxic to clean per message."""
    longest, n = emit.shape
    odds = np.exp(np.clip(emit, -30, 30))
    (stay, into), (out, on) = np.exp(steps)
    ahead = np.empty((longest, n))
    ahead[0] = odds[0] * np.exp(start[1] - start[0])
    for t in range(1, longest):
        ahead[t] = odds[t] * (into + ahead[t - 1] * on) / (stay + ahead[t - 1] * out)
    back = np.ones(n)
    for t in range(longest - 1, -1, -1):
        ratio = ahead[t] * back
        ahead[t] = ratio / (1 + ratio)
        if t:
            heard = odds[t] * back
            back = np.where(t >= size, 1.0, (out + on * heard) / (stay + into * heard))
    return ahead


class Words(dict):
    """Row number per word; a new word's emissions are computed once."""

    def __init__(self, field: Field) -> None:
        super().__init__()
        self.field = field
        self.rows: list[tuple[float, float, float, bool]] = []

    def __missing__(self, word: str) -> int:
        f = self.field
        context = slot("w", word.lower())
        at = self[word] = len(self.rows)
        self.rows.append(
            (
                float(f.weights[own_features(word)].sum()),
                float(f.before[context]),
                float(f.after[context]),
                word in ENDS,
            )
        )
        return at


class Scorer:
    """Chances per token of whole texts; emissions of words are kept up to CACHE words."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self.words = Words(field)
        self.known = np.zeros((0, 4))

    def _read(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > CACHE:
            self.words, self.known = Words(self.field), np.zeros((0, 4))
        number = self.words.__getitem__
        out = [np.fromiter(map(number, tokens(t)), np.int32) for t in texts]
        fresh = self.words.rows[len(self.known) :]
        if fresh:
            self.known = np.concatenate([self.known, np.array(fresh, float)])
        return out

    def chances(self, texts: list[str]) -> list[np.ndarray]:
        ids = self._read(texts)
        lengths = np.array([len(i) for i in ids], int)
        total = int(lengths.sum())
        out = np.zeros(total)
        if total:
            flat = np.concatenate(ids)
            own, before, after, mark = self.known.T
            ends = mark[flat] > 0
            start, size = chains(lengths, ends)
            if len(start):
                inside = np.zeros(total, bool)  # the token before belongs to the same chain
                inside[1:] = ~ends[1:] & ~ends[:-1]
                inside[start] = False
                emit = own[flat]
                emit[1:] += before[flat[:-1]] * inside[1:]
                emit[:-1] += after[flat[1:]] * inside[1:]
                order = np.argsort(size, kind="stable")
                for a in range(0, len(order), 2048):
                    pick = order[a : a + 2048]
                    values, at = padded(emit, start[pick], size[pick])
                    chance = toxic_chances(
                        np.ascontiguousarray(values.T), size[pick], self.field.steps, self.field.start
                    ).T
                    real = at >= 0
                    out[at[real]] = chance[real]
        return np.split(out, np.cumsum(lengths)[:-1]) if len(lengths) else []


FOUND = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("start", T.IntegerType()),
                        T.StructField("end", T.IntegerType()),
                        T.StructField("chance", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)


def offending(text: str, chance: np.ndarray) -> list[dict]:
    """Runs of tokens that are toxic rather than not, as code-point offsets of the text."""
    hot = chance >= 0.5
    if not hot.any():
        return []
    out: list[dict] = []
    last = -2
    for i, m in enumerate(TOKEN.finditer(text)):
        if not hot[i]:
            continue
        if last == i - 1 and out:
            out[-1]["end"] = m.end()
            out[-1]["chance"] = max(out[-1]["chance"], float(chance[i]))
        else:
            out.append({"start": m.start(), "end": m.end(), "chance": float(chance[i])})
        last = i
    return out


def grouped(texts: list[str], chars: int = 4_000_000):
    """Slices of a batch that hold about `chars` characters, so long texts need no more memory."""
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def score_toxicity(df: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """`df` with `score` (chance that the document is toxic) and `spans` (start, end, chance).

    Every token of the whole text gets the chance of the toxic state; spans are runs of tokens at
    0.5 or more, offsets count code points. Null and empty texts have the score of a text without
    toxic tokens and no spans. Rows are scored on their own in Arrow batches: repeated rows score
    alike, columns named score or spans are replaced, others stay.
    """
    shared = df.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf(FOUND)
    def apply(texts: pd.Series) -> pd.DataFrame:
        scorer = _scorer(shared)
        score, spans = [], []
        rows = list(texts)
        for a, b in grouped(rows):
            for text, chance in zip(rows[a:b], scorer.chances(rows[a:b]), strict=True):
                x = np.array([*summary(chance), 1.0])
                score.append(float(sigmoid(x @ shared.value.calibration)))
                spans.append(offending(text, chance))
        return pd.DataFrame({"score": score, "spans": spans})

    found = free_names(df, "_found")[0]
    kept = without(df, ("score", "spans"))
    rows = df.select(*kept, apply(text_of(text_col)).alias(found))
    return rows.select(
        *kept, col(found)["score"].alias("score"), col(found)["spans"].alias("spans")
    )


_SCORERS: dict[int, Scorer] = {}


def _scorer(shared) -> Scorer:
    """One scorer per worker and model, so that its word cache outlives a batch."""
    key = id(shared.value)
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(shared.value)
    return _SCORERS[key]


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """The field fitted on a bounded sample of labelled rows that are not held out: about PER_CLASS
    documents per label of MAX_CHARS characters at most. Without labelled rows all scores are low."""
    rows = learning_sample(
        docs,
        labels,
        "toxic",
        per_class=PER_CLASS,
        max_chars=MAX_CHARS,
        seed=SEED,
        id_col=id_col,
        text_col=text_col,
    )
    return fit_field(one_per_group(rows))


THRESHOLD = 0.3


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of query 3."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, field).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.array_join(
            F.transform(
                "spans",
                lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        ).alias("spans"),
    )
