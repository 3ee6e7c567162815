"""Columns that clash, rows that must not vanish, and results against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.llm import decontaminate, mixing, near, secrets, sharding, warc
from stayledger.session import work_path

CLASHES = {
    "root": 1, "copies": "c", "_of": 2, "_first": 3, "_one": 4,
    "_full": 5, "_cut": 6, "_n": 7, "score": 9.5, "spans": "s",
    "items": "i", "n_hit": -1, "epoch": 8, "tokens": -2, "shard": "x",
    "slot": "y", "_fa": 0, "a.b": "dot", "class_id": "own",
}


@pytest.fixture(scope="module")
def clashing(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({k: F.lit(v) for k, v in CLASHES.items()}).cache()


def test_operators_take_clashing_columns(spark, sf_dir, clashing):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    n = clashing.count()
    assert near.near_duplicates(clashing).count() == n
    assert near.keep_one(clashing).columns == clashing.columns
    assert decontaminate.mark_contaminated(clashing, bench).count() == n
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    assert mixing.mix(clashing, levels=levels, weights=[{}, {}], budget_share=1.0).count() == n
    assert sharding.shard(clashing, 3).count() == n


def test_stages_keep_clashing_columns(spark, sf_dir, clashing):
    import corpus_pipeline as pipeline

    for name, stage in pipeline.STAGES:
        out = stage(spark, clashing, sf_dir)
        if name == "sharding":
            assert set(out.columns) == set(clashing.columns)
            assert out.where("shard NOT BETWEEN 0 AND 39").count() == 0
            continue
        assert out.columns == clashing.columns, name
        assert 0 < out.count() <= clashing.count()
        carried = out.select("score", "items", "root", "`a.b`", "tokens", "shard").distinct().collect()
        assert [tuple(r) for r in carried] == [(9.5, "i", 1, "dot", -2, "x")], name
        assert stage(spark, clashing.limit(0), sf_dir).count() == 0 or name == "toxicity"


def test_stages_equal_brute_force_on_their_own_input(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = {r.doc_id: re.findall(near.GAP, (r.text or "").lower()) for r in docs.collect()}
    grams = {
        i: {tuple(w[k : k + min(5, len(w))]) for k in range(len(w) - min(5, len(w)) + 1)} if w else set()
        for i, w in words.items()
    }
    ids = sorted(grams)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(grams[a] & grams[b])
            if both and both >= 0.8 * (len(grams[a]) + len(grams[b]) - both):
                root[max(find(a), find(b))] = min(find(a), find(b))
    kept = {r.doc_id for r in pipeline.drop_near_copies(spark, docs, sf_dir).collect()}
    assert kept == {i for i in ids if find(i) == i}
    classes = {r.doc_id: r.class_id for r in near.near_duplicates(docs).collect()}
    assert classes == {i: find(i) for i in ids}


def test_near_copies_of_planted_texts_equal_all_pairs(spark):
    rng = np.random.default_rng(8)
    rows = []
    for base in range(25):
        text = [f"v{x}" for x in rng.integers(0, 3000, 60)]
        for _ in range(12):
            own = list(text)
            for at in rng.integers(0, 60, rng.integers(0, 5)):
                own[at] = f"v{rng.integers(0, 3000)}"
            rows.append((len(rows), " ".join(own)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(56)} for _, t in rows]
    links = {i: 0 for i in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
    out = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.links for r in out.collect()} == links


@pytest.mark.parametrize("sign", ["\u2028", "\u2029", "\x85", "\n", "\x0b", "\r\n"])
def test_an_address_cannot_forge_a_header(spark, sign):
    pages = [(1, "http://a/", "one"), (2, f"http://x/{sign}Content-Length: 3", "second page"), (3, "http://b/", "3rd")]
    path = work_path(spark, "forged")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), path)
    got = {r.page_id: r.payload for r in warc.read_archives(spark, path).collect()}
    assert got == {1: "one", 2: "second page", 3: "3rd"}
    assert warc.unread_tails(spark, path).count() == 0


def test_broken_archives_are_reported(spark, tmp_path):
    def record(name, body, length=True):
        head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{name}>\r\n"
        size = f"Content-Length: {len(body)}\r\n" if length else ""
        return f"{head}{size}\r\n{body}\r\n\r\n"

    body = "HTTP/1.1 200 OK\r\n\r\nhello"
    files = {
        "whole": record(1, body) + record(2, body),
        "no_length": record(3, body) + record(4, body, length=False) + record(5, body),
        "no_magic": "junk" + record(6, body),
    }
    for name, text in files.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.warc").write_bytes(text.encode())
    read = {n: {r.page_id: r.payload for r in warc.read_archives(spark, str(tmp_path / n)).collect()} for n in files}
    assert read["whole"] == {1: "hello", 2: "hello"}
    assert read["no_length"][3] == "hello" and read["no_length"][4] is None and 5 not in read["no_length"]
    assert read["no_magic"] == {}
    tails = {n: [(r.off, r.bytes) for r in warc.unread_tails(spark, str(tmp_path / n)).collect()] for n in files}
    assert tails["whole"] == []
    assert len(tails["no_length"]) == 1 and tails["no_length"][0][1] > len(record(5, body))
    assert tails["no_magic"] == [(0, len(files["no_magic"]))]


@pytest.mark.parametrize("epochs", [1, 3])
def test_a_leaf_without_tokens_is_taken_whole(spark, epochs):
    rows = [(1, "some words here", "a"), (2, "", "empty"), (3, None, "empty"), (4, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, levels={"source": F.col("source")}, weights=[{}], budget_share=1.0, max_epochs=epochs)
    taken = [(r.doc_id, r.epoch) for r in out.collect()]
    assert {i for i, _ in taken} == {1, 2, 3, 4} and len(taken) == len(set(taken))
    assert {e for i, e in taken if i in (2, 3)} == set(range(epochs))


def test_base_secrets_equal_a_plain_scan(spark, sf_dir):
    assign = re.compile(
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = {}
    for r in docs.collect():
        t = r.text or ""
        want[r.doc_id] = (
            sum(len(m[2]) >= 6 for m in assign.finditer(t)),
            sum(len(m[0]) >= 20 for m in re.finditer("AKIA[A-Z0-9]+", t)),
            sum(len(m[0]) >= 24 for m in re.finditer("[0-9a-f]+", t)),
        )
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex) for r in secrets.op2_secrets(spark, sf_dir).collect()}
    assert got == want
