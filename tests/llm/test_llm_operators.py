"""Corpus operators on small tables: brute force, round trips and odd rows."""

import base64
import bz2
import gzip
import lzma
import zlib
from urllib.parse import quote

import numpy as np
import pytest

from stayledger.llm import chat, decontaminate, mixing, near, quality, rules, secrets, sharding
from stayledger.llm import toxicity, warc
from stayledger.llm.labelled import auc
from stayledger.session import work_path
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, shard string, `_key` int, label int"
WORDS = [f"w{i}x" for i in range(400)]


def words(a, n):
    return " ".join(WORDS[(a * 37 + i * (a % 7 + 1)) % 400] for i in range(n))


ROWS = [
    (1, words(1, 60), "en", "src1", "s", 1, 1),
    (1, words(1, 60), "en", "src1", "s", 1, 1),  # a repeated row
    (2, words(1, 60).replace(WORDS[37], "changed", 1), "en", "src1", None, None, 0),
    (3, words(5, 80), None, None, "s", 1, 1),
    (4, "", "fr", "src2", "s", 1, 1),
    (5, None, "fr", "src2", "s", 1, 1),
    (None, words(8, 30), "de", "src3", "s", 1, 1),
    (None, None, None, None, None, None, None),
    (6, "one two", "de", "src3", "s", 1, 1),
    (7, words(9, 3000), "de", "src0", "s", 1, 1),
    (8, " \n\t ", "de", "src0", "s", 1, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def test_shards_differ_by_one_row_and_have_no_gaps(spark, odd, none):
    rows = sharding.shard(odd, 3).collect()
    assert len(rows) == len(ROWS)
    sizes = [sorted(r.slot for r in rows if r.shard == s) for s in range(3)]
    assert all(x == list(range(len(x))) for x in sizes)
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    assert all(sharding.where(r.row_number, len(rows), 3) == (r.shard, r.slot) for r in rows)
    assert sharding.shard(none, 3).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 37, 1000])
def test_permutation_is_a_bijection(spark, n):
    p = sharding.plan_permutation(spark, n, 3)
    out = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), p)).collect()]
    assert sorted(out) == list(range(n))


def test_secrets_below_layers_map_back():
    plain = "password=abc123def"
    coded = base64.b64encode(plain.encode()).decode()
    packed = base64.b64encode(gzip.compress((plain + " and more text").encode(), mtime=0)).decode()
    for text, part in (
        ("x " + plain, plain),
        ("x " + quote(plain), quote(plain)),
        ("x " + coded + " y", coded),
        ("x " + base64.b64encode(("k " + coded).encode()).decode(), None),
        ("x " + packed, packed),
        ("\\u0070assword=abc123def", "\\u0070assword=abc123def"),
    ):
        spans, over = secrets.find(text)
        assert spans and not over
        if part:
            assert text[spans[0][1] : spans[0][2]] == part
    assert secrets.find("token=abc secret: token: abcdefgh")[0] == []
    assert secrets.find("") == ([], 0)


def test_secrets_in_large_wrapped_prefixed_and_joined_blocks(monkeypatch):
    plain = b"password=abc123def"

    def found(text):
        spans, over = secrets.find(text)
        return [(k, text[a:b]) for k, a, b, _ in spans], over

    for pack in (gzip.compress, bz2.compress, lzma.compress):
        two = base64.b64encode(pack(b"nothing here, ") + pack(plain)).decode()
        assert found("x " + two) == ([("assign", two)], 0)
    noise = "".join(f"{i * 7919 % 10007} " for i in range(400)).encode()
    flat = base64.b64encode(gzip.compress(noise + plain, mtime=0)).decode()
    lines = "\n".join(flat[i : i + 76] for i in range(0, len(flat), 76))
    assert ("assign", lines) in found(f"begin:\n\n{lines}\n")[0]
    cut = base64.b64encode(b"some words before " * 2 + plain + b" and some after").decode()
    lines = cut[:56] + "\r\n" + cut[56:]
    assert any("\r\n" in part for _, part in found("x: " + lines)[0])
    for prefix in ("/", "ab/", "path/", "a/path/"):
        for body in (plain, gzip.compress(plain, mtime=0)):
            assert found("http://h." + prefix + base64.b64encode(body).decode())[0]
    monkeypatch.setattr(secrets, "MAX_UNPACKED", 1 << 16)
    monkeypatch.setattr(secrets, "OVERLAP", 1 << 10)
    for at in (10, (1 << 16) - 8, 150_000, 299_000):
        text = (b"a bc\xc3\xa9. " * 40_000)[: at - at % 9] + plain + b" " + b"a bc. " * 50_000
        coded = base64.b64encode(gzip.compress(text)).decode()
        assert found(coded) == ([("assign", coded)], 0)
    big = base64.b64encode(lzma.compress(plain, preset=9)).decode()
    assert secrets.find(big)[1] == 1


def test_secrets_of_odd_rows(odd, none):
    found = secrets.find_secrets(odd)
    assert found.count() == len(ROWS)
    assert set(odd.columns) < set(found.columns)
    assert secrets.find_secrets(none).count() == 0


def test_rules_on_odd_rows(odd, none):
    rows = {(r.doc_id, r.text): r for r in rules.judge(odd).collect()}
    assert rows[(5, None)].n_words == 0 and not rows[(5, None)].kept
    assert rows[(1, words(1, 60))].n_words == 60
    long = rows[(7, words(9, 3000))]
    split = long.text.split()
    grams = [tuple(split[i : i + 5]) for i in range(len(split) - 4)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    assert long.n_repeat_words == len(inside)
    assert rules.judge(none).count() == 0


def brute_hits(text, items):
    split = text.split() if text else []
    hit, found = set(), set()
    for item, own in items:
        n = min(10, len(own))
        wanted = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(split) - n + 1) if n else ():
            if tuple(split[i : i + n]) in wanted:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(hit), sorted(found)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, -1])
def test_decontamination_equals_brute_force(spark, odd, none, limit):
    texts = [
        (1, " ".join(words(1, 60).split()[5:25])),
        (2, "one two"),
        (3, None),
        (4, " ".join(["aa"] * 14)),
        (None, words(5, 80)),
    ]
    more = odd.unionByName(
        spark.createDataFrame([(9, "bb " + "aa " * 12 + "cc")], "doc_id long, text string"),
        allowMissingColumns=True,
    )
    bench = spark.createDataFrame(texts, "item_id long, text string").where("item_id IS NOT NULL")
    got = decontaminate.mark_contaminated(more, bench, broadcast_bytes=limit).collect()
    items = [(str(i), t.split() if t else []) for i, t in texts if i is not None]
    assert len(got) == len(ROWS) + 1
    for r in got:
        assert (r.n_hit, list(r["items"])) == brute_hits(r.text, items)
        assert r.contaminated == (r.n_hit > 0)
    assert decontaminate.mark_contaminated(none, bench).count() == 0
    assert not decontaminate.mark_contaminated(odd, bench.limit(0)).where("contaminated").count()


def test_near_duplicates_equal_brute_force(odd, none):
    got = near.near_duplicates(odd).collect()
    by = {(r.doc_id, r.text): r for r in got}
    assert len(got) == len(ROWS)
    pair = by[(1, words(1, 60))]
    assert pair.class_id == 1 and pair.links == 2
    assert by[(2, ROWS[2][1])].class_id == 1
    assert by[(4, "")].links == 0 and by[(4, "")].class_id == 4
    kept = near.keep_one(odd).collect()
    assert sum(r.doc_id == 1 for r in kept) == 1 and not any(r.doc_id == 2 for r in kept)
    assert len(kept) == len(ROWS) - 2
    assert near.near_duplicates(none).count() == 0


def test_mix_redistributes_to_siblings_first(spark, odd, none):
    leaves = spark.createDataFrame(
        [("a", "x", 10), ("a", "y", 100), ("b", "x", 100)], "p string, q string, cap long"
    )
    given = mixing.leaf_budgets(leaves, ["p", "q"], [{}, {}], 120).collect()
    assert {(r.p, r.q): r.given for r in given} == {("a", "x"): 10, ("a", "y"): 50, ("b", "x"): 60}
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    whole = mixing.mix(odd, levels=levels, weights=[{}, {}], budget_share=1.0)
    assert whole.where("tokens > 0").count() == sum(bool(r[1] and r[1].split()) for r in ROWS)
    half = mixing.mix(odd, levels=levels, weights=[{}, {}], budget_share=0.5).agg(F.sum("tokens"))
    assert half.first()[0] <= sum(len((r[1] or "").split()) for r in ROWS) // 2
    assert mixing.mix(none, levels=levels, weights=[{}, {}]).count() == 0


def test_every_speaker_is_the_assistant_once(spark):
    said = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "<|x|>"), (1, 3, "ann", None)]
    odd_rows = [(None, None, None, "lost"), (2, 0, "system", "alone"), (1, 3, "ann", None)]
    table = spark.createDataFrame(
        said + odd_rows, "conv_id long, turn long, role string, text string"
    ).withColumn("block", F.lit(1))
    got = {(r.conversation, r.perspective): r for r in chat.rendered(chat.segments(table)).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (None, "unknown")}
    ann = got[(1, "ann")]
    assert [ann.text[a:b] for a, b in ann.masks] == ["hi<|im_end|>\n"] + ["<|im_end|>\n"] * 2
    assert "user name=bob" in ann.text and "<|x" not in ann.text
    parts = chat.rendered(chat.segments(table), 2).where("perspective = 'ann'").orderBy("part")
    assert "".join(r.text for r in parts.collect()) == ann.text
    assert chat.segments(table.limit(0)).count() == 0


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_keep_payloads_that_hold_records(spark, compression):
    fake = "a WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nx"
    pages = [(1, "u", fake), (2, "u", "same"), (3, None, "same"), (4, "u\r\nX: y", None), (5, "v", "")]
    pages += [(6, "u", "WARC/1.0\r\n"), (7, "u", "é" * 4000), (None, "u", "lost")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    path = work_path(spark, "test-archives")
    warc.write_archives(table, path, compression=compression)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        got = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == len(pages)
    for page, _, html in pages:
        if page == 2:
            assert got[2].record_type == "revisit" and got[2].refers_to == 3
        elif page == 4:
            assert got[4].record_type == "revisit" and got[4].refers_to == 5
        else:
            assert got[page].record_type == "response" and got[page].payload == (html or "")
    empty = work_path(spark, "test-archives")
    warc.write_archives(table.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_survive_another_packing_of_the_files(spark, monkeypatch, compression):
    pages = [(i, f"u{i}", words(i, 40)) for i in range(120)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(6)
    path = work_path(spark, "test-archives")
    warc.write_archives(table, path, compression=compression)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")  # all files in one partition
    follow = warc.reachable

    def repacked(links):  # between the chain and the payloads, as when executors come or go
        out = follow(links)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "900b")
        return out

    monkeypatch.setattr(warc, "reachable", repacked)
    try:
        got = warc.read_archives(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert sorted((r.page_id, r.payload) for r in got) == [(i, html) for i, _, html in pages]


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_toxicity_on_held_out_rows(spark, sf_dir, odd, none):
    bad = ["foulword", "nastything", "vileperson"]
    docs, labels = [], []
    for i in range(600):
        text = words(i, 40 + i % 30).split()
        if i % 3 == 0:
            text[5] = bad[i % 3 + i % 2]
            text[17] = bad[(i // 3) % 3]
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 3 == 0)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    field = toxicity.fit_toxicity(table, spark.createDataFrame(labels, "doc_id long, toxic int"))
    rows = [r for r in toxicity.score_toxicity(table, field).collect() if held(r.doc_id)]
    assert auc([r.score for r in rows], [int(r.doc_id % 3 == 0) for r in rows]) > 0.97
    hot = next(r for r in rows if r.doc_id % 3 == 0 and r.spans)
    assert any(hot.text[s.start : s.end] in bad for s in hot.spans)
    assert toxicity.score_toxicity(odd, field).count() == len(ROWS)
    assert toxicity.score_toxicity(none, field).count() == 0
    untaught = toxicity.fit_toxicity(table, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_toxicity(table, untaught).agg(F.max("score")).first()[0] < 0.3


def test_chain_chances_equal_enumeration():
    rng = np.random.default_rng(0)
    emit, steps, start = rng.normal(size=(1, 5)), rng.normal(size=(2, 2)), rng.normal(size=2)
    total = np.zeros(5)
    z = 0.0
    for code in range(32):
        y = [code >> t & 1 for t in range(5)]
        s = start[y[0]] + sum(emit[0, t] * y[t] for t in range(5))
        w = np.exp(s + sum(steps[a, b] for a, b in zip(y, y[1:], strict=False)))
        z += w
        total += w * np.array(y)
    size = np.array([5])
    full, _, log_z = toxicity.forward_backward(emit, size, steps, start)
    assert np.allclose(full[0], total / z) and np.isclose(log_z[0], np.log(z))
    fast = toxicity.toxic_chances(emit.T.copy(), size, steps, start)
    assert np.allclose(fast[:, 0], total / z)


def test_quality_on_held_out_rows(spark, odd, none):
    docs, labels = [], []
    for i in range(400):
        text = words(i, 50).split()
        if i % 4 == 0:
            text = [w + "%%%" for w in text]
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 4 != 0)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    network = quality.fit_quality(table, spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = [r for r in quality.score_quality(table, network).collect() if held(r.doc_id)]
    assert auc([r.score for r in rows], [int(r.doc_id % 4 != 0) for r in rows]) > 0.97
    assert quality.score_quality(odd, network).where("score BETWEEN 0 AND 1").count() == len(ROWS)
    assert quality.score_quality(none, network).count() == 0


def test_pipeline_drops_planted_rows(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = pipeline.run(spark, sf_dir)
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert 0 < len(ids) < docs.count() and len(ids) == len(set(ids))
    assert set(docs.columns) < set(out.columns)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert not decontaminate.mark_contaminated(out, bench).where("contaminated").count()
    assert not near.near_duplicates(out).where("links > 0").count()
