"""Source divergence audit: stripes folded in the mapper, merged by term, read as divergences.

A task folds whole documents into stripes, term to (document frequency, counts by source), and
spills them when they are many. Stripes of a term merge after one shuffle. All numbers are integers.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, file_stage, text_of

MIN_DOCS = 30  # documents of a language that hold a kept term
UNIT = 1_000_000_000
PRIOR = 5
TOP_TERMS = 50
TERM = "[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SPILL_ENTRIES = 1_000_000  # counts that a task holds before it writes its stripes
SPILL_ROWS = 20_000
TILE_TERMS = 1024
BLOCK_SOURCES = 512
HELD_CELLS = 4_000_000  # sums of pairs that a task holds before it writes them

STRIPE_TYPE = "lang string, term string, df long, sources array<string>, counts array<long>"
LOWER = str.maketrans(UPPER, UPPER.lower())


class Stripes:
    """Counts of the documents folded so far, by language."""

    def __init__(self) -> None:
        self.df: dict[str, Counter] = defaultdict(Counter)
        self.by_source: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def fold(self, lang: str, source: str, terms: list[str]) -> None:
        self.df[lang].update(set(terms))
        self.by_source[lang, source].update(terms)

    def entries(self) -> int:
        return sum(map(len, self.df.values())) + sum(map(len, self.by_source.values()))

    def batches(self) -> Iterator[pa.RecordBatch]:
        """One row a term, and one row without a term that names all sources of a language.

        Entries are gathered column by column, so no row is built in Python.
        """
        of_lang: dict[str, list[str]] = defaultdict(list)
        for lang, source in self.by_source:
            of_lang[lang].append(source)
        for lang, sources in of_lang.items():
            counters = [self.by_source[lang, s] for s in sources]
            df = self.df[lang]
            place = dict(zip(df, range(1, len(df) + 1), strict=True))
            ahead = len(sources)  # the row without a term
            at = np.concatenate(
                [np.zeros(ahead, np.int64)]
                + [np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in counters]
            )
            n = np.concatenate(
                [np.zeros(ahead, np.int64)] + [np.fromiter(c.values(), np.int64, len(c)) for c in counters]
            )
            who = np.r_[np.arange(ahead), np.repeat(np.arange(ahead), [len(c) for c in counters])]
            order = np.argsort(at, kind="stable")
            ends = np.cumsum(np.bincount(at, minlength=len(df) + 1))
            offsets = pa.array(np.r_[0, ends].astype(np.int32))
            names = pa.array(sources, pa.string()).take(pa.array(who[order]))
            whole = pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(df) + 1), pa.string()),
                    pa.array([None, *df], pa.string()),
                    pa.array(np.r_[0, np.fromiter(df.values(), np.int64, len(df))]),
                    pa.ListArray.from_arrays(offsets, names),
                    pa.ListArray.from_arrays(offsets, pa.array(n[order])),
                ],
                names=["lang", "term", "df", "sources", "counts"],
            )
            for start in range(0, whole.num_rows, SPILL_ROWS):
                yield whole.slice(start, SPILL_ROWS)


def _fold(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Stripes of the documents, written whenever a task holds more than `most` counts."""
    find = re.compile(TERM).findall
    held = Stripes()
    for rows in batches:
        langs, sources, texts = (rows.column(k) for k in range(3))
        for n in range(rows.num_rows):
            text = texts[n].as_py()
            low = text.lower() if text.isascii() else text.translate(LOWER)
            held.fold(langs[n].as_py(), sources[n].as_py(), find(low))
            if n % 64 == 63 and held.entries() > most:
                yield from held.batches()
                held = Stripes()
    yield from held.batches()


def stripes(
    df: DataFrame,
    *,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """(lang, term, df, stripe) of the kept terms, the stripe an array of (source, n); a row without
    a term has all sources of the language with count 0.

    Tasks send a term once per spill, so a frequent term costs a few rows a task, and both merges
    use the one shuffle by (lang, term).
    """
    rows = df.select(
        text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).alias("text")
    )
    most = SPILL_ENTRIES
    folded = rows.mapInArrow(lambda batches: _fold(batches, most), STRIPE_TYPE)
    parts = folded.repartition("lang", "term")
    each = parts.select(
        "lang", "term", "df", F.posexplode(F.arrays_zip("sources", "counts")).alias("at", "one")
    )
    by_source = each.groupBy("lang", "term", F.col("one.sources").alias("source")).agg(
        F.sum("one.counts").alias("n"),
        F.sum(F.when(F.col("at") == 0, F.col("df")).otherwise(0)).alias("df"),
    )
    return (
        by_source.groupBy("lang", "term")
        .agg(F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("stripe"))
        .where(F.col("term").isNull() | (F.col("df") >= min_docs))
    )


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + PRIOR) / (total + PRIOR * terms)), exact."""
    above = F.lit(UNIT).cast("decimal(38,0)") * (n + PRIOR).cast("decimal(20,0)")
    below = (total + PRIOR * terms).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def shares(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """`share` of a matrix of counts; the quotient is built three digits at a time, so that nothing
    leaves 64 bits while a language has under 9e15 words."""
    rest = counts + PRIOR
    out = np.zeros_like(rest)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + digit
    return out + 1


def _pair_sums(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Sums of each source of a block against all sources, over the tiles that a task reads."""
    held: dict[tuple[str, int], tuple[list[str], np.ndarray]] = {}

    def written() -> Iterator[pd.DataFrame]:
        for (lang, first), (names, sums) in held.items():
            for k in range(len(sums)):
                mine = names[first + k]
                sent = pd.DataFrame({"lang": lang, "source": mine, "item": names, "value": sums[k]})
                yield sent[sent["item"] != mine]
        held.clear()

    for tiles in batches:
        for tile in tiles.itertuples():
            names = [str(s) for s in tile.sources]
            at = {s: k for k, s in enumerate(names)}
            counts = np.zeros((tile.held, len(names)), np.int64)
            counts[tile.term, [at[s] for s in tile.source]] = tile.n
            below = np.asarray(tile.totals, np.int64) + PRIOR * tile.terms
            p = shares(counts, below) if len(counts) else counts
            first = tile.first
            last = min(first + tile.width, len(names))
            _, sums = held.setdefault(
                (tile.lang, first), (names, np.zeros((last - first, len(names)), np.int64))
            )
            for k in range(first, last):
                sums[k - first] += np.abs(p - p[:, k : k + 1]).sum(axis=0)
            if sum(s.size for _, s in held.values()) > most:
                yield from written()
    yield from written()


def _numbered(stripe: Column, place: Column) -> Column:
    """The entries of a stripe with its place in the tile."""
    return F.transform(
        stripe, lambda x: F.struct(place.alias("term"), x["source"].alias("source"), x["n"].alias("n"))
    )


def divergences(merged: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) from stripes.

    `pair`: the sum of share differences to each other source over all kept terms; a task folds the
    tiles of terms that it reads into one matrix of sources and sends its sums once. `term`: the
    terms whose share in the group is above that in the language, `top` at most.
    """
    each = merged.select("lang", "term", F.explode("stripe").alias("one")).select(
        "lang", "term", "one.source", "one.n"
    )
    groups = file_stage(
        each.groupBy("lang", "source").agg(F.sum("n").alias("total")), "groups"
    )
    langs = file_stage(
        merged.groupBy("lang")
        .agg(F.count("term").alias("terms"))
        .join(
            groups.groupBy("lang").agg(
                F.sum("total").alias("lang_total"),
                F.sort_array(F.collect_list(F.struct("source", "total"))).alias("all"),
            ),
            "lang",
        ),
        "langs",
    )

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return rows.select(
            "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
        )

    tiles = (
        merged.join(langs.select("lang", "terms"), "lang")
        .groupBy(
            "lang",
            F.pmod(F.xxhash64("term"), F.expr(f"terms div {TILE_TERMS} + 1")).alias("tile"),
        )
        .agg(F.collect_list(F.when(F.col("term").isNotNull(), F.col("stripe"))).alias("stripes"))
        .select("lang", F.size("stripes").alias("held"), F.flatten(F.transform("stripes", _numbered)).alias("cell"))
        .select("lang", "held", "cell.term", "cell.source", "cell.n")
    )
    blocks = langs.select(
        "lang",
        "terms",
        F.col("all.source").alias("sources"),
        F.col("all.total").alias("totals"),
        F.explode(F.sequence(F.lit(0), F.size("all") - 1, F.lit(BLOCK_SOURCES))).alias("first"),
        F.lit(BLOCK_SOURCES).alias("width"),
    )
    most = HELD_CELLS
    sums = tiles.join(blocks, "lang").mapInPandas(
        lambda batches: _pair_sums(batches, most), "lang string, source string, item string, value long"
    )
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    counted = merged.where("term IS NOT NULL").select(
        "lang",
        "term",
        F.aggregate("stripe", F.lit(0).cast("long"), lambda acc, x: acc + x["n"]).alias("lang_n"),
        F.explode("stripe").alias("one"),
    )
    known = counted.select("lang", "term", "lang_n", "one.source", "one.n").where("n > 0")
    met = known.join(groups, ["lang", "source"]).join(langs.drop("all"), "lang")
    gained = met.select(
        "lang",
        "source",
        F.col("term").alias("item"),
        (
            share(F.col("n"), F.col("total"), F.col("terms"))
            - share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
        ).alias("value"),
    ).where("value > 0")
    return ranked(pairs, "pair").unionByName(ranked(gained, "term").where(F.col("rank") <= top))


def audit(
    df: DataFrame,
    *,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """Divergences of every source from the others of its language, and the terms that mark it.

    Null text, language or source is the empty string. A group without terms takes part with counts
    of 0; in a language without kept terms all pairs have value 0. A source that is alone in its
    language has no pairs. Repeated rows count each. An empty table gives no rows; only the three
    named columns are read, so others may have any names.
    """
    merged = stripes(df, lang_col=lang_col, source_col=source_col, text_col=text_col, min_docs=min_docs)
    return divergences(file_stage(merged, "stripes"), top)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of query 12."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return audit(docs.select(col("lang"), col("source"), col("text")))


_P = f"CAST(1 + (CAST({UNIT} AS HUGEINT) * ({{n}} + {PRIOR})) // ({{total}} + {PRIOR} * v) AS BIGINT)"
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{TERM}') AS w
  FROM documents),
words AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term)
  GROUP BY ALL),
grid AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM groups JOIN kept USING (lang)
  LEFT JOIN counts USING (lang, source, term)),
totals AS (SELECT lang, source, sum(n) AS total FROM grid GROUP BY ALL),
whole AS (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM grid
  GROUP BY lang, term),
q AS (SELECT lang, term, {_P.format(n="n", total="total")} AS q FROM whole JOIN sizes USING (lang)),
p AS (SELECT lang, source, term, n, {_P.format(n="n", total="total")} AS p
  FROM grid JOIN totals USING (lang, source) JOIN sizes USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
  CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part
  ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
