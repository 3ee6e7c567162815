"""The forest: sorted tries, prefixes shortened where groups differ, recall against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.llm import near


def planted(bases, copies, words, most, seed):
    """(doc_id, text) rows: near copies, of up to `most` changed words, of random texts."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(bases):
        text = [f"v{x}" for x in rng.integers(0, 5000, words)]
        for _ in range(copies):
            own = list(text)
            for at in rng.integers(0, words, rng.integers(0, most + 1)):
                own[at] = f"v{rng.integers(0, 5000)}"
            rows.append((len(rows), " ".join(own)))
    return rows


def all_pairs(rows, threshold=0.8):
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    links = {i: 0 for i in range(len(rows))}
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j < i}:
            both = len(s & sets[j])
            if both >= threshold * (len(s) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    return links, {i: find(i) for i in range(len(root))}


def test_lengths_end_where_the_recall_is_met():
    forest = near.Forest()
    assert forest.lengths[0] == forest.depth and forest.lengths[-1] == forest.shortest
    assert forest.recall_at(forest.shortest) >= forest.recall > forest.recall_at(forest.shortest + 1)
    loose = near.Forest(threshold=0.3, trees=64, depth=16, recall=0.9)
    assert loose.longest == loose.shortest + 7
    with pytest.raises(ValueError):
        _ = near.Forest(trees=1).shortest


def test_a_longer_prefix_lies_within_a_shorter_one(spark):
    forest = near.Forest()
    docs = spark.createDataFrame(planted(6, 10, 80, 4, 1), "doc_id long, text string")
    signed = near.signatures(docs.select("text", F.col("doc_id").cast("string").alias("key")), forest)
    paths = near.tries(signed)
    counts = []
    for length in forest.lengths:
        nodes = paths.select(*forest.node(length), "key").groupBy("label", "twig").count()
        counts.append(nodes.count())
        assert nodes.agg(F.sum("count")).first()[0] == paths.count()
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[-1]
    assert paths.groupBy("label").count().where("count < 2").isEmpty()


@pytest.mark.parametrize("blocks", [256, 8])
def test_links_and_classes_equal_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(near, "BLOCK_TEXTS", blocks)
    rows = list(enumerate(t for _, t in planted(30, 20, 70, 4, 3) + planted(1, 150, 90, 3, 4)))
    links, classes = all_pairs(rows)
    out = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(links.values()) > 2000
    assert {r.doc_id: r.links for r in out} == links
    assert {r.doc_id: r.class_id for r in out} == classes


def test_nodes_of_several_groups_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(near, "LOOSE", 1.0)  # no text joins a group, so every node keeps several
    monkeypatch.setattr(near, "BLOCK_TEXTS", 4)
    rows = planted(8, 12, 60, 3, 9)
    links, classes = all_pairs(rows)
    out = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in out} == classes
    assert {r.doc_id: r.links for r in out} == links


def test_one_row_of_each_class_and_all_blank_ones_stay(spark):
    rows = planted(5, 6, 60, 2, 2) + [(None, ""), (90, None), (91, " \x0b\n"), (91, " \x0b\n"), (92, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, classes = all_pairs([r for r in rows if r[0] is not None and r[0] < 90])
    kept = [r.doc_id for r in near.keep_one(docs).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [*set(classes.values()), None, 90, 91, 91, 92]))


def test_rounds_take_few_stages(spark):
    rows = planted(10, 8, 60, 3, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sc = spark.sparkContext
    sc.setJobGroup("few-stages", "near duplicates")
    try:
        found = near.near_duplicates(docs).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("few-stages")]
    assert {r.doc_id: r.class_id for r in found} == all_pairs(rows)[1]
    assert 0 < len(jobs) < 170


def test_groups_move_towards_their_centres(spark):
    roots = spark.createDataFrame([(k, k, 1) for k in "abcdefgh"], "key string, root string, n long")
    star = [("a", "d"), ("b", "d"), ("c", "d"), ("e", "d"), ("f", "e")]
    found = spark.createDataFrame(star, "root string, other string")
    got = {r.key: r.root for r in near.moved(roots, found, 0).collect()}
    assert got == dict.fromkeys("abcdef", "d") | {"g": "g", "h": "h"}
