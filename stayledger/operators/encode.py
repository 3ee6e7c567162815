"""Categorical encoding with state fitted on train only.

State tables are long: (feature, level, n, value). They are settled once, so fitting costs one pass,
and applied with a size-checked lookup.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import flag, level_key
from ..schema import Roles
from ..session import settle
from .lookup import BROADCAST_ROWS, attach
from .split import stratified_folds

MAX_ONE_HOT_LEVELS = 1_000


def levels_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(feature, level) rows of the given categoricals, null as a level of its own."""
    cells = [F.struct(F.lit(c).alias("feature"), level_key(c).alias("level")) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))


def level_sums(
    train: DataFrame, columns: Sequence[str], target: str | None = None, k: int = 0
) -> DataFrame:
    """Settled sums per (feature, level): rows, labelled rows n and positives s, also per fold.

    One grouping serves the frequency code, the target code and its out-of-fold form; hot levels are
    folded map-side.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    if target:
        y = F.col(target)
        aggs += [F.count(y).alias("n"), F.coalesce(F.sum(y), F.lit(0)).alias("s")]
        for j in range(k):
            mine = F.when(F.col("fold") == j, y)
            aggs += [
                F.count(mine).alias(f"n{j}"),
                F.coalesce(F.sum(mine), F.lit(0)).alias(f"s{j}"),
            ]
    keep = ([target] if target else []) + (["fold"] if k else [])
    return settle(levels_long(train, columns, keep).groupBy("feature", "level").agg(*aggs))


def frequency_from(sums: DataFrame) -> DataFrame:
    """Share of each level among train rows."""
    totals = sums.groupBy("feature").agg(F.sum("rows").alias("n_total"))
    return sums.join(F.broadcast(totals), "feature").select(
        "feature",
        "level",
        F.col("rows").alias("n"),
        (F.col("rows") / F.col("n_total")).alias("value"),
    )


def fit_frequency(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    return frequency_from(level_sums(train, columns))


def _one_feature(sums: DataFrame) -> DataFrame:
    """The sums of a single feature; over its levels they add up to all train rows."""
    feature = sums.agg(F.min("feature")).first()[0]
    return sums.where(F.col("feature") == F.lit(feature))


def target_means_from(sums: DataFrame, m: float = 20.0) -> tuple[DataFrame, float | None]:
    """Smoothed target mean per level, and the prior; (sum + m * prior) / (count + m)."""
    prior = _one_feature(sums).agg(F.try_divide(F.sum("s").cast("double"), F.sum("n"))).first()[0]
    value = F.try_divide(F.col("s") + F.lit(m) * F.lit(prior), F.col("n") + F.lit(m))
    seen = F.when(F.col("n") > 0, value).otherwise(F.lit(prior)).cast("double")
    return sums.select("feature", "level", "n", seen.alias("value")), prior


def fit_target_means(
    train: DataFrame, columns: Sequence[str], target: str, m: float = 20.0
) -> tuple[DataFrame, float | None]:
    return target_means_from(level_sums(train, columns, target), m)


def out_of_fold_from(
    sums: DataFrame, k: int = 5, m: float = 20.0, absent: str = "fold_prior"
) -> DataFrame:
    """Per (feature, level, fold) the smoothed mean over all *other* folds.

    The other folds' sums are the level's total minus the fold's own, so no fold is scanned twice.
    A level that the other folds never saw gets their prior, or the prior of all train rows with
    absent="global_prior".
    """
    whole = (
        _one_feature(sums)
        .agg(*[F.sum(c).alias(c) for c in ["n", "s", *[f"{x}{j}" for j in range(k) for x in "ns"]]])
        .first()
    )

    def share(s: float | None, n: float | None) -> float | None:
        return s / n if n else None

    global_prior = share(whole["s"], whole["n"])
    cells = []
    for j in range(k):
        prior = share(
            (whole["s"] or 0) - (whole[f"s{j}"] or 0), (whole["n"] or 0) - (whole[f"n{j}"] or 0)
        )
        n_other = F.col("n") - F.col(f"n{j}")
        smoothed = F.try_divide(
            F.col("s") - F.col(f"s{j}") + F.lit(m) * F.lit(prior), n_other + F.lit(m)
        )
        unseen = F.lit(prior if absent == "fold_prior" else global_prior)
        cells.append(
            F.struct(
                F.lit(j).alias("fold"),
                F.col(f"n{j}").alias("n"),
                F.when(n_other > 0, smoothed).otherwise(unseen).cast("double").alias("value"),
            )
        )
    return sums.select("feature", "level", F.inline(F.array(*cells))).where("n > 0")


def fit_target_means_out_of_fold(
    folded: DataFrame,
    columns: Sequence[str],
    target: str,
    k: int = 5,
    m: float = 20.0,
    absent: str = "fold_prior",
) -> DataFrame:
    return out_of_fold_from(level_sums(folded, columns, target, k), k, m, absent)


def apply_levels(
    df: DataFrame,
    state: DataFrame,
    columns: Sequence[str],
    suffix: str,
    default: float | None,
    also_on: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add `{column}{suffix}` from the state; unseen levels get the default."""
    kept = list(df.columns)
    sizes = {r["feature"]: r["count"] for r in state.groupBy("feature").count().collect()}
    for c in columns:
        out = f"{c}{suffix}"
        one = state.where(F.col("feature") == c).select(
            F.col("level").alias("_level"), *also_on, "n", F.col("value").alias(out)
        )
        df = attach(
            df.withColumn("_level", level_key(c)),
            one,
            ["_level", *also_on],
            broadcast_rows=broadcast_rows,
            state_rows=sizes.get(c, 0),
        )
        kept.append(out)
        df = df.withColumn(out, F.coalesce(F.col(out), F.lit(default).cast("double"))).select(*kept)
    return df


def train_levels(
    train: DataFrame, columns: Sequence[str], max_levels: int = MAX_ONE_HOT_LEVELS
) -> dict[str, list[str]]:
    """Sorted train levels per low-cardinality column; refuses a column with too many."""
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in columns
    ]
    found = train.select(F.inline(F.array(*cells))).where("level is not null").distinct()
    rows = found.limit(max_levels * len(columns) + 1).collect()
    levels = {c: sorted(r["level"] for r in rows if r["feature"] == c) for c in columns}
    wide = [c for c, v in levels.items() if len(v) > max_levels]
    if wide or len(rows) > max_levels * len(columns):
        raise ValueError(f"too many levels to one-hot encode in {wide or list(columns)}")
    return levels


def one_hot(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """0/1 column per train level named `{column}_{level}`; unseen and null are all zero.

    Dots in a level become underscores in the name; levels that then share a name share a column.
    """
    named: dict[str, list] = {}
    for c, values in levels.items():
        for level in values:
            named.setdefault(f"{c}_{level}".replace(".", "_"), []).append((c, level))
    out = {
        name: flag(reduce(or_, [F.col(c).cast("string") == F.lit(level) for c, level in pairs]))
        for name, pairs in named.items()
    }
    return df.withColumns(out).drop(*levels)


@dataclass
class EncoderState:
    """Everything learned from train that encoding needs."""

    frequency: DataFrame
    target_means: DataFrame
    prior: float | None
    levels: dict[str, list[str]]
    high_card: list[str] = field(default_factory=list)
    drop_after: list[str] = field(default_factory=list)

    def apply(self, df: DataFrame) -> DataFrame:
        """Encode rows that took no part in fitting: test, batch scoring, stream micro-batches."""
        df = apply_levels(df, self.frequency, self.high_card, "_freq", 0.0)
        df = apply_levels(df, self.target_means, self.high_card, "_te", self.prior)
        return self._finish(df)

    def _finish(self, df: DataFrame) -> DataFrame:
        return one_hot(df.drop(*self.high_card), self.levels).drop(*self.drop_after)


def fit_encoders(train: DataFrame, roles: Roles = Roles(), m: float = 20.0) -> EncoderState:
    sums = level_sums(train, roles.high_card, roles.target)
    means, prior = target_means_from(sums, m)
    return EncoderState(
        frequency_from(sums),
        means,
        prior,
        train_levels(train, roles.nominal),
        list(roles.high_card),
        list(roles.drop_after_encoding),
    )


def encode_train_test(
    train: DataFrame,
    test: DataFrame,
    roles: Roles = Roles(),
    k: int = 5,
    m: float = 20.0,
    seed: int | str = 42,
    absent: str = "fold_prior",
) -> tuple[DataFrame, DataFrame, EncoderState]:
    """Train rows get out-of-fold target codes, test rows the full-train ones.

    Train is read several times: pass a staged table.
    """
    folded = stratified_folds(train, roles.target, roles.id, k, seed)
    sums = level_sums(folded, roles.high_card, roles.target, k)
    means, prior = target_means_from(sums, m)
    state = EncoderState(
        frequency_from(sums),
        means,
        prior,
        train_levels(train, roles.nominal),
        list(roles.high_card),
        list(roles.drop_after_encoding),
    )
    oof = out_of_fold_from(sums, k, m, absent)
    coded = apply_levels(folded, state.frequency, roles.high_card, "_freq", 0.0)
    coded = apply_levels(coded, oof, roles.high_card, "_te", prior, also_on=["fold"])
    return state._finish(coded.drop("fold")), state.apply(test), state
