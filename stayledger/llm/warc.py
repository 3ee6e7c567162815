"""WARC archives: written as text files, read back by verifying the chain of record boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .common import col, file_stage, text_of

MAGIC = "WARC/1.0\r\n"
BREAK = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# Control characters and Unicode line ends, which some readers take for the end of a header line.
CONTROLS = "[\\x00-\\x1F\\x7F-\\x9F\\u2028\\u2029]"


def base32_sha1(data: Column) -> Column:
    """Upper-case base-32 SHA-1: five hex digits hold four letters."""
    digest = F.sha1(data)
    parts = []
    for i in range(8):
        number = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for j in range(4):
            at = F.shiftright(number, 15 - 5 * j).bitwiseAND(F.lit(31)) + 1
            parts.append(F.substr(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*parts)


def with_types(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Record type and reference per row of (id, uri, payload).

    The largest id of each payload is found by map-side folded counts, so a payload that a third of
    the pages share is one row per task. Only payloads held by several ids are joined back; that
    table is written first, so that the join sees two plain shuffles and can split a hot payload.
    """
    keyed = pages.withColumn("digest", base32_sha1(F.encode("payload", "UTF-8"))).withColumn(
        "bytes", F.octet_length("payload").cast("long")
    )
    groups = (
        keyed.where(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("id").alias("last"), F.min("id").alias("first"))
        .where(F.col("first") < F.col("last"))
        .select(F.col("digest").alias("of"), "last")
    )
    shared = file_stage(groups, "payloads")
    return (
        keyed.join(shared, F.col("digest") == F.col("of"), "left")
        .withColumn("refers_to", F.when(F.col("id") < F.col("last"), F.col("last")))
        .drop("of", "last")
    )


def record(rows: DataFrame) -> Column:
    """The record's text up to, not with, the two line breaks that end it."""
    revisit = F.col("refers_to").isNotNull()
    block = F.concat(F.lit(HTTP), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    name = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    lines = F.concat_ws(
        "\r\n",
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), name, F.lit(">")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.concat(
            F.lit("WARC-Target-URI: "),
            F.regexp_replace(F.coalesce(F.col("uri"), F.lit("about:blank")), CONTROLS, " "),
        ),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string")),
        F.when(
            revisit,
            F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")),
        ),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(F.lit(MAGIC), lines, F.lit(BREAK), block)


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    compression: str = "gzip",
) -> None:
    """One WARC record per row of `pages`, one archive per task, below `path`.

    Archives are compressed as whole files by default; "none" gives files that are read in splits.

    Of rows with equal payloads of at least `min_bytes` bytes the one with the largest id is the
    response and the others are revisits of it; rows that repeat that id are all responses. A null
    payload is empty, a null id is written as `null` and is always a response, control characters
    and Unicode line ends in an address become spaces, other columns are not stored. An empty table writes no record.
    """
    rows = pages.select(
        col(id_col).cast("long").alias("id"),
        col(uri_col).cast("string").alias("uri"),
        text_of(payload_col).alias("payload"),
    )
    typed = with_types(rows, min_bytes)
    (
        typed.select(record(typed).alias("value"))
        .write.option("lineSep", BREAK)
        .text(path, compression=compression)
    )


def header_field(header: Column, name: str) -> Column:
    """The value of a header line; only CR LF ends a line."""
    return F.regexp_extract(header, f"(?i)(?:^|\\r\\n){name}:[ \\t]*([^\\r\\n]*)", 1)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut behind every occurrence of the magic, written once: file (hash of its path),
    split, seq (order of reading), size (bytes with the magic), skip (bytes from the magic to the
    next record, if the piece starts with a header that tells its length) and the piece itself.

    seq holds the number of the partition, and another scan may pack the files into other partitions,
    so chain and payloads are both taken from this one compressed copy.
    """
    header = F.substring_index("piece", BREAK, 1)
    length = header_field(header, "Content-Length")
    skip = (
        2 * len(BREAK)
        + len(MAGIC)
        + F.octet_length(header)
        + F.when(length.rlike("^[0-9]{1,18}$"), length.cast("long"))
    )
    raw = spark.read.option("lineSep", MAGIC).text(path).select(
        F.xxhash64(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("piece"),
    )
    size = F.octet_length("piece").cast("long") + len(MAGIC)
    cut = raw.select("file", "split", "seq", size.alias("size"), skip.alias("skip"), "piece")
    return file_stage(cut, "pieces", compression="zstd")


def candidates(cut: DataFrame) -> DataFrame:
    """Each magic with its byte offset, and the offset at which its record, if it is one, ends.

    Lengths are summed inside a split in reading order, and a split starts where the ones before it
    in its file end, so no task sees more than the sizes of one split. The piece before the first
    magic of a file (empty in a well-formed one) has the offset -10 and is no candidate.
    """
    sizes = cut.select("file", "split", "seq", "size", "skip")
    # One row per split: bounded by the size of the archives over the size of a split.
    held = sizes.groupBy("file", "split").agg(F.sum("size").alias("held"))
    before = held.selectExpr(
        "file",
        "split",
        "coalesce(sum(held) OVER (PARTITION BY file ORDER BY split "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base",
    )
    inner = sizes.selectExpr(
        "*",
        "coalesce(sum(size) OVER (PARTITION BY file, split ORDER BY seq "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inner_off",
    )
    off = F.col("base") + F.col("inner_off") - len(MAGIC)
    placed = inner.join(before, ["file", "split"]).withColumn("off", off).where("off >= 0")
    return placed.select(
        "file", "split", "seq", "off", (F.col("off") + F.col("skip")).alias("next")
    )


def reachable(links: DataFrame) -> DataFrame:
    """Offsets on the chain from the start of each file, by pointer jumping.

    Round k holds, for every candidate, the one 2^k records ahead; what is reached so far then
    doubles. Rounds are logarithmic in the records of the longest file, and each is one join on
    (file, offset) of slim rows, cut from its lineage.
    """
    jump = file_stage(links.where("next IS NOT NULL").select("file", "off", "next"), "jump")
    known = links.select("file", "off")
    reached = file_stage(known.where("off = 0"), "reached")
    count = reached.count()
    while True:
        ahead = reached.join(jump.hint("merge"), ["file", "off"]).select("file", F.col("next").alias("off"))
        found = file_stage(
            ahead.union(reached).distinct().join(known.hint("merge"), ["file", "off"], "left_semi"), "reached"
        )
        now = found.count()
        if now == count:
            return found
        reached, count = found, now
        second = jump.select("file", F.col("off").alias("next"), F.col("next").alias("far"))
        jump = file_stage(
            jump.join(second.hint("merge"), ["file", "next"]).select("file", "off", F.col("far").alias("next")),
            "jump",
        )


def owners(found: DataFrame, chain: DataFrame) -> DataFrame:
    """For each piece the record that holds it, and the number of pieces of that record.

    It is the last reached offset at or before the piece: inside its split, else the last one of an
    earlier split (one row per split). Pieces before any record have no owner.
    """
    real = chain.withColumn("real", F.lit(True)).hint("merge")
    marked = found.join(real, ["file", "off"], "left")
    inside = marked.selectExpr(
        "file",
        "split",
        "seq",
        "off",
        "max(CASE WHEN real THEN off END) OVER (PARTITION BY file, split ORDER BY off) AS inside",
    )
    last = marked.groupBy("file", "split").agg(F.max(F.when(F.col("real"), F.col("off"))).alias("last"))
    carried = last.selectExpr(
        "file",
        "split",
        "max(last) OVER (PARTITION BY file ORDER BY split "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carry",
    )
    held = file_stage(
        inside.join(carried, ["file", "split"]).select(
            "file", "split", "seq", "off", F.coalesce("inside", "carry").alias("owner")
        ),
        "owners",
    ).where("owner IS NOT NULL")
    parts = held.groupBy("file", "owner").agg(F.count(F.lit(1)).alias("parts"))
    return held.join(file_stage(parts.where("parts > 1"), "cut"), ["file", "owner"], "left")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below `path`: file, off, header fields and payload.

    Every occurrence of the magic is a candidate record. Tasks emit (offset, successor) pairs, and
    only candidates on the chain from the start of a file are kept, so a magic inside a payload is
    part of that payload. A payload cut by such magics is put together again from its pieces; only
    those records are grouped, all others pass through one join. An empty folder gives no rows. A
    record without a length has no payload (null) and ends the chain of its file; `unread_tails`
    reports what lies behind it.
    """
    cut = pieces(spark, path)
    found = file_stage(candidates(cut), "candidates")
    plan = file_stage(owners(found, reachable(found)), "plan")
    on = ["file", "split", "seq"]
    bodies = cut.select(*on, "piece").join(plan.hint("merge"), on)
    single = bodies.where("parts IS NULL").select("file", "off", F.col("piece").alias("body"))
    part = F.struct("off", "piece").alias("part")
    several = (
        bodies.where("parts IS NOT NULL")
        .groupBy("file", F.col("owner").alias("off"))
        .agg(F.sort_array(F.collect_list(part)).alias("rows"))
        .select(
            "file", "off", F.array_join(F.transform("rows", lambda p: p["piece"]), MAGIC).alias("body")
        )
    )
    whole = single.unionByName(several).withColumn("header", F.substring_index("body", BREAK, 1))

    def field(name: str) -> Column:
        return header_field(F.col("header"), name)

    def page(name: str) -> Column:
        return F.regexp_extract(field(name), "urn:page:(-?[0-9]+)", 1).try_cast("long")

    content = F.col("body").substr(F.length("header") + len(BREAK) + 1, F.length("body"))
    block = F.substring(F.encode(content, "UTF-8"), F.lit(1), field("Content-Length").try_cast("int"))
    return (
        whole.select(
            "file",
            "off",
            field("WARC-Type").alias("record_type"),
            page("WARC-Record-ID").alias("page_id"),
            field("WARC-Target-URI").alias("url"),
            field("X-Payload-Length").try_cast("long").alias("payload_bytes"),
            F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
            page("WARC-Refers-To").alias("refers_to"),
            F.decode(block, "UTF-8").alias("block"),
        )
        .withColumn(
            "payload",
            F.col("block").substr(F.instr("block", BREAK) + len(BREAK), F.length("block")),
        )
        .drop("block")
    )


def unread_tails(spark: SparkSession, path: str) -> DataFrame:
    """(file, off, bytes): the part of each archive that no chain of records reaches, if there is one.

    A file that doesn't begin with a record is unread from 0 on; one with a broken record is unread
    behind it. Files that were written whole give no row.
    """
    cut = pieces(spark, path)
    found = file_stage(candidates(cut), "candidates")
    chain = reachable(found)
    size = (F.sum("size") - len(MAGIC)).alias("size")
    whole = cut.groupBy("file").agg(size)
    last = chain.join(found, ["file", "off"]).groupBy("file").agg(
        F.max_by(F.struct("off", "next"), "off").alias("last")
    )
    end = F.coalesce("last.next", F.col("last.off") + len(MAGIC), F.lit(0).cast("long"))
    tails = whole.join(last, "file", "left").select("file", end.alias("off"), (F.col("size") - end).alias("bytes"))
    return tails.where("bytes > 0")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of query 10: write one record per page, read the archives back.

    Size and digest of a response are computed from the payload that was read; a revisit carries
    those of the full payload in its header.
    """
    path = work_path(spark, "archives")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    back = read_archives(spark, path)
    response = F.col("record_type") == "response"
    return back.select(
        "page_id",
        F.when(response, F.octet_length("payload").cast("long"))
        .otherwise(F.col("payload_bytes"))
        .alias("payload_bytes"),
        F.when(response, base32_sha1(F.encode("payload", "UTF-8")))
        .otherwise(F.col("payload_digest"))
        .alias("payload_digest"),
        "record_type",
        "refers_to",
    )


ORACLE = f"""
WITH digests AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
ends AS (SELECT h, max(page_id) AS last FROM digests GROUP BY h)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('{BASE32}', 1 + CAST(
    (CAST('0x' || substr(h, 1 + CAST(i // 4 AS INTEGER) * 5, 5) AS BIGINT)
      >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM digests JOIN ends USING (h)"""
