"""Benchmark decontamination by winnowing: shared minimum hashes, extended to whole spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, file_stage, free_names, joined_digest, run_at, text_of, without

SPAN = 10  # words of a shared span that must be found
GRAM = 5  # words of one hashed gram
REACH = SPAN - GRAM  # how far a span can stretch to either side of a gram inside it
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Fingerprints of the benchmark go to every executor up to this many bytes, else both sides shuffle.
BROADCAST_BYTES = 64 << 20


def word_list(text: Column) -> Column:
    """Lower-cased words; only A to Z change case."""
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    return F.array_remove(F.split(low, BREAKS), "")


def with_fingerprints(df: DataFrame, words: str, shorts: Sequence[int], out: str) -> DataFrame:
    """Adds an array of (length, place, value): winnowed grams, and all grams of the short lengths.

    A span of SPAN words holds REACH + 1 grams. The leftmost smallest hash of each such run is kept,
    so two texts that share a span keep the same gram of it. Places count from 1.
    """
    grams, lows, places = free_names(df, "_grams", "_lows", "_places")
    w, g, low = col(words), col(grams), col(lows)
    n = F.size(w)
    run = REACH + 1

    def spread(length: int) -> Column:
        return F.sequence(F.lit(1), n - (length - 1))

    def hashes(length: int) -> Column:
        return F.transform(spread(length), lambda i: F.xxhash64(*run_at(w, i, length)))

    def leftmost(i: Column) -> Column:
        least = F.get(low, i - 1)
        out = i + (run - 1)
        for k in reversed(range(run - 1)):
            out = F.when(F.get(g, i + (k - 1)) == least, i + k).otherwise(out)
        return out

    hashed = df.withColumn(grams, F.when((n >= SPAN) & (F.size(w) >= SPAN), hashes(GRAM)))
    minima = hashed.withColumn(
        lows,
        F.when(
            (n >= SPAN) & (F.size(g) >= run),
            F.transform(spread(SPAN), lambda i: F.least(*run_at(g, i, run))),
        ),
    )
    kept = minima.withColumn(
        places, F.when(F.size(low) >= 1, F.array_distinct(F.transform(spread(SPAN), leftmost)))
    )

    def print_of(length: int, place: Column, value: Column) -> Column:
        return F.struct(
            F.lit(length).alias("length"), place.cast("int").alias("place"), value.alias("value")
        )

    none = F.array().cast("array<struct<length:int,place:int,value:bigint>>")
    long = F.coalesce(
        F.transform(places, lambda p: print_of(SPAN, p, F.get(g, p - 1))), none
    )
    parts = [long]
    for length in shorts:
        some = F.transform(spread(length), _short(length, w, print_of))
        parts.append(F.when(n >= length, some).otherwise(none))
    return kept.withColumn(out, F.concat(*parts)).drop(grams, lows, places)


def _short(length: int, words: Column, print_of):
    return lambda i: print_of(length, i, F.xxhash64(*run_at(words, i, length)))


def around(words: str, place: Column) -> Column:
    """The gram at `place` with up to REACH words on either side."""
    first = F.greatest(place - REACH, F.lit(1))
    return F.slice(col(words), first, place + SPAN - first)


def left_of(place: Column) -> Column:
    """Words before the gram in `around`."""
    return F.least(place - 1, F.lit(REACH))


def extension(step: int, here: Column, there: Column, at: Column, to: Column) -> Column:
    """How many words match one after the other from (at, to) on, in steps of +1 or -1."""
    out = F.lit(REACH)
    for k in reversed(range(REACH)):
        equal = F.coalesce(
            F.get(here, at + step * k) == F.get(there, to + step * k), F.lit(False)
        )
        out = F.when(equal, out).otherwise(F.lit(k))
    return out


def benchmark_prints(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[int]]:
    """Fingerprints of the items (length, value, item, in_place, in_words), written once, and the
    word counts of items shorter than a span. Items without words have none."""
    items = benchmark.select(
        col(id_col).cast("string").alias("item"), word_list(text_of(text_col)).alias("words")
    )
    sizes = items.groupBy(F.size("words").alias("n")).count().where(F.col("n").between(1, SPAN - 1))
    shorts = sorted(r["n"] for r in sizes.collect())  # below SPAN values
    longs = with_fingerprints(items.where(F.size("words") >= SPAN), "words", [], "prints")
    whole = items.where(F.size("words").between(1, SPAN - 1)).select(
        "item",
        "words",
        F.array(
            F.struct(
                F.size("words").alias("length"),
                F.lit(1).alias("place"),
                F.xxhash64("words").alias("value"),
            )
        ).alias("prints"),
    )
    prints = longs.select("item", "words", "prints").unionByName(whole).select(
        "item", "words", F.explode_outer("prints").alias("p")
    )
    place = F.col("p.place")
    table = prints.select(
        F.col("p.length").alias("in_length"),
        F.col("p.value").alias("in_value"),
        "item",
        place.alias("in_place"),
        around("words", place).alias("in_words"),
    )
    return file_stage(table, "benchmark"), shorts


def find_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Shared spans: the columns of `docs`, `item`, `start`, `end` (word places from 0, end excluded).

    Fingerprints of both sides join on their value. A match is verified word by word and extended up
    to REACH words to each side: it is a span if SPAN words match, or the whole of a shorter item.
    A span longer than that is reported in overlapping pieces, since each of its windows has a
    fingerprint of its own. The benchmark is sent to all executors only if its written fingerprints
    are below `broadcast_bytes`; else both sides shuffle by value.
    """
    prints, shorts = benchmark_prints(benchmark, item_col, item_text_col)
    bytes_held = prints.select(
        F.sum(40 + F.octet_length("item") + F.octet_length(F.array_join("in_words", "  ")) * 2)
    ).first()[0]
    words, fps, p = free_names(docs, "_words", "_prints", "_print")
    worded = docs.withColumn(words, word_list(text_of(text_col)))
    base = [col(c) for c in docs.columns if c != text_col]
    # The outer form yields one empty row for a text without grams, and keeps Spark from testing
    # "has any grams" below the projections, where all hashing would be computed once more.
    marked = with_fingerprints(worded.select(*base, words), words, shorts, fps)
    single = marked.select(*base, words, F.explode_outer(fps).alias(p))
    place = col(p)["place"]
    flat = single.select(
        *base,
        words,
        col(p)["length"].alias("length"),
        place.alias("place"),
        col(p)["value"].alias("value"),
    )
    near = around(words, F.col("place")).alias("near_words")
    on = (F.col("length") == F.col("in_length")) & (F.col("value") == F.col("in_value"))
    if (bytes_held or 0) <= broadcast_bytes:
        met = flat.join(F.broadcast(prints), on).select("*", near).drop(words)
    else:
        met = flat.select("*", near).drop(words).hint("merge").join(prints, on)
    here, there = F.col("near_words"), F.col("in_words")
    at, to = left_of(F.col("place")), left_of(F.col("in_place"))
    long = F.col("length") == SPAN
    grams = F.when(long, GRAM).otherwise(F.col("length"))
    back = F.when(long, extension(-1, here, there, at - 1, to - 1)).otherwise(0)
    ahead = F.when(long, extension(1, here, there, at + GRAM, to + GRAM)).otherwise(0)
    checked = met.where(F.slice(here, at + 1, grams) == F.slice(there, to + 1, grams)).select(
        *base,
        "item",
        (F.col("place") - 1 - back).alias("start"),
        (F.col("place") - 1 + grams + ahead).alias("end"),
        "length",
    )
    return checked.where(F.col("end") - F.col("start") >= F.col("length")).drop("length")


def mark_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`docs` with n_words, n_hit (words inside any shared span), items (sorted ids), contaminated.

    A window is SPAN consecutive words of an item, or the whole of a shorter item. Null and empty
    texts have no words and are clean; an item without words matches nothing; with an empty
    benchmark all documents are clean. Repeated rows get equal results, a null id is a value like
    any other. Columns of these names are replaced. Results meet the documents by a 128-bit hash of
    (id, text), so copies of a text spread over as many keys as they have ids.
    """
    kept = docs.select(*without(docs, ("n_words", "n_hit", "items", "contaminated")))
    a, b, found_a, found_b = free_names(kept, "_a", "_b", "_fa", "_fb")
    ident = F.coalesce(col(id_col).cast("string"), F.lit("null"))
    text = text_of(text_col)
    keys = [F.xxhash64(ident, text).alias(a), F.xxhash64(text, ident, F.lit(1)).alias(b)]
    slim = docs.select(*keys, text.alias("text"))
    spans = find_spans(slim, benchmark, text_col="text", broadcast_bytes=broadcast_bytes).distinct()
    hits = file_stage(spans, "spans")
    per_word = (
        hits.select(a, b, F.explode(F.sequence("start", F.col("end") - 1)).alias("at"))
        .groupBy(a, b)
        .agg(F.count_distinct("at").alias("n_hit"))
    )
    per_item = hits.groupBy(a, b).agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = file_stage(per_word.join(per_item, [a, b]), "hits").select(
        col(a).alias(found_a), col(b).alias(found_b), "n_hit", "items"
    )
    rows = kept.select("*", F.size(word_list(text)).cast("long").alias("n_words"), *keys)
    # Results grow with the corpus, so they are joined by shuffle at every size.
    joined = rows.join(found.hint("merge"), (col(a) == col(found_a)) & (col(b) == col(found_b)), "left")
    return joined.select(
        *[col(c) for c in kept.columns],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of query 7."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marked = mark_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        joined_digest(F.col("items")).alias("items_sha256"),
        "contaminated",
    )


_SQL_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), "
    f"'{UPPER}', '{UPPER.lower()}'), '{BREAKS}'), lambda x: x <> '')"
)
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
wanted AS (SELECT DISTINCT item_id, least(len(w), {SPAN}) AS k,
    array_to_string(w[i:i + least(len(w), {SPAN}) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {SPAN - 1}, 1) + 1)) AS i FROM items
    WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT k FROM wanted),
windows AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, lengths)),
found AS (SELECT r, windows.k, i, item_id FROM windows JOIN wanted USING (k, s)),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM found)
  GROUP BY r),
held AS (SELECT r, count(DISTINCT item_id) AS n_items,
  string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  hit.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN held USING (r)"""
