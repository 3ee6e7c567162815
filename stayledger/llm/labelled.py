"""A bounded sample of labelled documents for fitting, and what fits share."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, held_out, text_of

# Hash values a labelled row can have; a class keeps those below its share.
SLOTS = 1_000_000


def learning_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    *,
    per_class: int,
    max_chars: int,
    seed: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> pd.DataFrame:
    """About `per_class` texts of each label, as (text, label), at most 1.25 times as many.

    Only labelled rows that are not held out and have at most `max_chars` characters are eligible.
    A class is thinned by a hash of the id, so the ids are chosen from the labels alone: they are few
    by construction, are sent to all executors, and one scan of the documents picks the texts. Rows
    of equal id count once, null ids and null labels are left out.
    """
    known = (
        labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    share = {r["label"]: per_class / r["count"] for r in known.groupBy("label").count().collect()}
    slot = F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(SLOTS))
    most = F.when(F.col("label") == 1, int(SLOTS * min(1.0, share.get(1, 0)))).otherwise(
        int(SLOTS * min(1.0, share.get(0, 0)))
    )
    chosen = known.where(slot < most).orderBy(slot).limit(int(per_class * 2.5))
    rows = (
        docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
        .where(F.length("text") <= max_chars)
        .join(F.broadcast(chosen), "id")
        .dropDuplicates(["id"])
        .select("id", "text", "label")
        .toPandas()
    )
    return rows.sort_values("id", kind="stable").reset_index(drop=True)


def one_per_group(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows whose smallest word hashes differ: near copies mostly share them."""
    marks = [
        tuple(sorted({zlib.crc32(w.encode()) for w in re.findall(r"\S+", t)})[:3]) for t in rows["text"]
    ]
    return rows.loc[~pd.Series(marks, index=rows.index).duplicated()].reset_index(drop=True)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Weights (the last is the constant) of a ridge logistic regression, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) / len(y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def auc(score: Iterable[float], label: Iterable[int]) -> float:
    """Chance that a label-1 row scores above a label-0 row, ties counted half."""
    s, y = np.asarray(score, float), np.asarray(label)
    values, at, count = np.unique(s, return_inverse=True, return_counts=True)
    upto = np.cumsum(count) - (count - 1) / 2
    ranks = upto[at]
    ones = int(y.sum())
    zeros = len(y) - ones
    if not ones or not zeros:
        return float("nan")
    return float((ranks[y == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros))
