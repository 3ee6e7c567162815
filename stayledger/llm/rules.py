"""Quality rules: a threshold table compiled into column expressions, without user functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, col, free_names, run_at, text_of, without

WINDOW = 5
SYMBOLS = "#*$%&|<>"
GAP = "[\\x20\\x09-\\x0D]+"

# Frequent function words of the languages in use.
STOP_WORDS = (
    "the of and to in is that it for as with was on are be this have from or an at by not a",
    "le la les de des du un une et en que qui pour par dans est au ce il elle ne pas",
    "der die das und in zu den von mit ist des im dem nicht ein eine es auf für sich",
    "el los las del y que en un una por con para es se su al lo como más o esta",
)


@dataclass(frozen=True)
class Rule:
    """`least` <= feature <= `most` must hold for documents of at least `min_words` words."""

    name: str
    feature: str
    least: float | None = None
    most: float | None = None
    min_words: int = 0


# The first two are the base rules; the ratios are per word, per letter or per line.
RULES = (
    Rule("few_words", "n_words", least=10),
    Rule("repeated_windows", "repeat_percent", most=20),
    Rule("word_length", "mean_word_chars", least=1.5, most=25),
    Rule("symbols", "symbols_per_word", most=0.5),
    Rule("capitals", "capital_share", most=0.5),
    Rule("marks", "exclamations_per_word", most=0.5),
    Rule("stop_words", "stop_share", least=0.01, min_words=80),
    Rule("duplicate_lines", "dup_line_share", most=0.7),
)
BASE_RULES = ("few_words", "repeated_windows")


def removed(text: Column, kept: str) -> Column:
    """How many characters of the class `kept` the text has."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def repeated_positions(keyed: str) -> Column:
    """Starts of windows that occur twice, from windows sorted by (hash, words, start)."""

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["h"] == b["h"]) & (a["w"] == b["w"]), F.lit(False))

    twice = F.filter(
        keyed,
        lambda x, j: same(x, F.get(col(keyed), j - 1)) | same(x, F.get(col(keyed), j + 1)),
    )
    return F.sort_array(F.transform(twice, lambda x: x["i"]))


def covered(starts: Column, window: int) -> Column:
    """Words inside any of the windows that begin at the sorted `starts`."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last"))
    return F.aggregate(
        starts,
        zero,
        lambda acc, p: F.struct(
            (acc["n"] + F.least(F.lit(window), p - acc["last"])).alias("n"), p.alias("last")
        ),
        lambda acc: acc["n"],
    )


def measure(df: DataFrame, text_col: str = "text") -> DataFrame:
    """`df` with the counts that rules use: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_capitals, n_exclamations, n_stop_words.

    Windows are compared by hash first; only documents with an equal pair of hashes compare the
    words themselves, so a collision changes nothing.
    """
    text, words, lines, hashes, keyed, starts = free_names(
        df, "_text", "_words", "_lines", "_hashes", "_keyed", "_starts"
    )
    t, w = col(text), col(words)
    n = F.col("n_words")
    spread = F.sequence(F.lit(1), (n - (WINDOW - 1)).cast("int"))
    stop = sorted({s for line in STOP_WORDS for s in line.split()})
    counts = (
        "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_capitals "
        "n_exclamations n_stop_words"
    ).split()
    base = df.select(*without(df, counts), F.btrim(text_of(text_col), F.lit(SPACES)).alias(text))
    split = base.withColumn(
        words, F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, GAP))
    ).withColumn(
        lines,
        F.filter(F.split(text_of(text_col), "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
    )
    counted = split.select(
        "*",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        removed(t, SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        removed(t, "A-Z").alias("n_capitals"),
        removed(t, "!").alias("n_exclamations"),
        F.size(F.filter(w, lambda x: x.isin(stop))).cast("long").alias("n_stop_words"),
    )
    hashed = counted.withColumn(
        hashes,
        F.when(
            (n >= WINDOW) & (F.size(w) >= WINDOW),
            F.transform(spread, lambda i: F.xxhash64(*run_at(w, i, WINDOW))),
        ),
    )
    h = col(hashes)
    sorted_windows = hashed.withColumn(
        keyed,
        F.when(
            F.size(F.array_distinct(h)) < F.size(h),
            F.sort_array(
                F.transform(
                    spread,
                    lambda i: F.struct(
                        F.get(h, i - 1).alias("h"),
                        F.concat_ws(" ", *run_at(w, i, WINDOW)).alias("w"),
                        i.alias("i"),
                    ),
                )
            ),
        ),
    )
    return (
        sorted_windows.withColumn(starts, repeated_positions(keyed))
        .withColumn(
            "n_repeat_words", F.coalesce(covered(col(starts), WINDOW), F.lit(0).cast("long"))
        )
        .drop(text, words, lines, hashes, keyed, starts)
    )


def features() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words"),
        "repeat_percent": 100 * F.col("n_repeat_words") / words,
        "mean_word_chars": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "capital_share": F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
        "exclamations_per_word": F.col("n_exclamations") / words,
        "stop_share": F.col("n_stop_words") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    }


def broken(rule: Rule) -> Column:
    value = features()[rule.feature]
    tests = []
    if rule.least is not None:
        tests.append(value < rule.least)
    if rule.most is not None:
        tests.append(value > rule.most)
    out = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return (F.col("n_words") >= rule.min_words) & out


def judge(df: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """`df` with the counts of `measure`, `failed` (names of broken rules) and `kept`.

    All rules are columns of one projection over the counts; nothing is shuffled. A null text is
    an empty one: no words, no lines, so it breaks `few_words`. Every row gets one verdict, repeated
    rows the same one; columns of the names written here are replaced, all others stay.
    """
    failed = F.array_compact(F.array(*[F.when(broken(r), r.name) for r in rules]))
    return (
        measure(df, text_col)
        .withColumn("failed", failed)
        .withColumn("kept", F.size("failed") == 0)
    )


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of query 5."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = F.arrays_overlap("failed", F.array(*[F.lit(x) for x in BASE_RULES]))
    return judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        "kept",
    )


def _sql_rule(rule: Rule) -> str:
    per = {
        "n_words": "n_words",
        "repeat_percent": "100 * n_repeat_words / greatest(n_words, 1)",
        "mean_word_chars": "word_chars / greatest(n_words, 1)",
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "capital_share": "n_capitals / greatest(word_chars, 1)",
        "exclamations_per_word": "n_exclamations / greatest(n_words, 1)",
        "stop_share": "n_stop / greatest(n_words, 1)",
        "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    }[rule.feature]
    ends = []
    if rule.least is not None:
        ends.append(f"{per} < {rule.least}")
    if rule.most is not None:
        ends.append(f"{per} > {rule.most}")
    return f"(n_words >= {rule.min_words} AND ({' OR '.join(ends)}))"


def oracle(rules: Sequence[Rule] = RULES) -> str:
    stop = ", ".join("'" + s + "'" for s in sorted({s for x in STOP_WORDS for s in x.split()}))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD_SQL}') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD_SQL}')) AS l FROM docs),
windows AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM split)),
twice AS (SELECT r, s FROM windows GROUP BY r, s HAVING count(*) > 1),
inside AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p
  FROM windows JOIN twice USING (r, s)) GROUP BY r),
counted AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
  length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals,
  length(regexp_replace(t, '[^!]+', '', 'g')) AS n_exclamations,
  len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop,
  CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM split LEFT JOIN inside USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT ({' OR '.join(_sql_rule(r) for r in rules)}) AS kept FROM counted"""


WORD_SQL = "[^\\x20\\x09-\\x0D]+"
