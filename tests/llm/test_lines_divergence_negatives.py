"""Line dedup, source divergences and hard negatives against brute force, with odd rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from stayledger.llm import divergence, lines, negatives

BLANKS = " \t\n\x0b\x0c\r"
COMMON = "This line is found in many Documents"
SCHEMA = "doc_id long, text string, lang string, source string, `a.b` int, n_lines string, _gone int"
ROWS = [
    (1, f"{COMMON}\nown line of the first document\n\nshort", "en", "s1", 1, "x", 1),
    (2, f"  {COMMON.upper()} \t\nown line of the second one\n{COMMON}", "en", "s2", 1, "x", 1),
    (3, f"{COMMON.lower()}\r\nend", "en", "s1", None, None, None),
    (3, f"{COMMON.lower()}\r\nend", "en", "s1", None, None, None),  # a repeated row
    (None, f"{COMMON}\nlast", "en", None, 1, "x", 1),
    (4, "", "fr", "s1", 1, "x", 1),
    (5, None, None, "s3", 1, "x", 1),
    (6, "ÉCOLE DES LIGNES RÉPÉTÉES\nx", "fr", "s1", 1, "x", 1),
    (7, "École des lignes répétées\ny", "fr", "s2", 1, "x", 1),
    (8, "ÉCOLE des lignes RÉPÉTÉES\nz", "fr", "s2", 1, "x", 1),
    (9, "\n".join([COMMON, "one two three"] * 2000), "de", "s1", 1, "x", 1),
    (0, "nineteen characters\n" * 3, "de", "", 1, "x", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def cut_lines(rows, min_docs=3):
    """(id, n_lines, n_dropped, text) of each row."""
    keyed = [[lower(x.strip(BLANKS)) for x in (t or "").split("\n")] for _, t in rows]
    held, keeper = Counter(), {}
    for (i, _), keys in zip(rows, keyed, strict=True):
        for k in {k for k in keys if len(k) >= 20}:
            held[k] += 1
            if i is not None and (keeper.get(k) is None or i > keeper[k]):
                keeper[k] = i
    out = []
    for (i, t), keys in zip(rows, keyed, strict=True):
        own = (t or "").split("\n")
        kept = [x for x, k in zip(own, keys, strict=True) if held[k] < min_docs or keeper.get(k) == i]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def spark_lines(df):
    rows = lines.drop_repeated_lines(df).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in rows), key=str)


def test_lines_equal_brute_force(odd):
    assert spark_lines(odd) == cut_lines([(r[0], r[1]) for r in ROWS])
    assert set(lines.drop_repeated_lines(odd).columns) >= {"a.b", "_gone", "n_lines", "n_dropped"}
    assert lines.drop_repeated_lines(odd.limit(0)).count() == 0


def test_lines_of_several_shards_and_copied_shards(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 8)
    rng = np.random.default_rng(5)
    pool = [f"line number {k} of a small pool" for k in range(60)]
    rows = [(k, "\n".join(pool[x] for x in rng.integers(0, 60, 6)) + f"\n{COMMON}") for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert spark_lines(df) == cut_lines(rows)


def test_missing_ids_lose_lines_to_any_other(spark):
    rows = [(None, COMMON)] * 2 + [(1, COMMON)]
    assert spark_lines(spark.createDataFrame(rows, "doc_id long, text string")) == cut_lines(rows)
    rows = [(None, COMMON)] * 3
    got = spark_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(n == 0 for _, _, n, _ in got)  # the largest id is the missing one


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 20000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
    place, sizes, bits = lines.build_hash(a, b)
    assert sorted(place) == list(range(n))
    assert (lines.find_place(a, b, sizes, bits) == place).all()
    assert bits.sum() == n


def test_shard_rejects_foreign_keys():
    rng = np.random.default_rng(1)
    own = pd.DataFrame(
        {
            "shard": 0,
            "a": rng.integers(-(1 << 62), 1 << 62, 500),
            "b": rng.integers(-(1 << 62), 1 << 62, 500),
            "n": rng.integers(1, 100_000, 500),
            "keeper": rng.integers(0, 9, 500),
        }
    )
    shard = lines.Shard(lines._build_shard(own).iloc[0])
    a, b = lines._unsigned(own["a"]), lines._unsigned(own["b"])
    count, keeper = shard.probe(a, b)
    assert (count == own["n"]).all() and (keeper == own["keeper"]).all()
    assert (shard.probe(a + np.uint64(1), b + np.uint64(1))[0] == 0).all()


def audit_by_hand(rows, min_docs, top=50):
    words = [
        (lang or "", source or "", re.findall(divergence.TERM, lower(text or ""))) for text, lang, source in rows
    ]
    df, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, w in words:
        df[lang].update(set(w))
        counts[lang, source].update(w)
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        mine = {s: c for (g, s), c in counts.items() if g == lang}
        whole = sum(mine.values(), Counter())

        def p(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        share, q = {s: p(c) for s, c in mine.items()}, p(whole)
        for s, c in mine.items():
            pairs = [(o, sum(abs(share[s][t] - share[o][t]) for t in kept)) for o in mine if o != s]
            terms = [(t, share[s][t] - q[t]) for t in kept if c[t] > 0 and share[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def spark_audit(df, **kw):
    return sorted(tuple(r) for r in divergence.audit(df, **kw).select(
        "lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("min_docs", [1, 2, 30])
def test_divergences_equal_brute_force(odd, min_docs):
    wanted = audit_by_hand([(r[1], r[2], r[3]) for r in ROWS], min_docs)
    assert spark_audit(odd, min_docs=min_docs) == wanted
    assert spark_audit(odd.limit(0)) == []


def test_divergences_with_spills_tiles_and_blocks(spark, monkeypatch):
    for name, value in (("SPILL_ENTRIES", 50), ("TILE_TERMS", 7), ("BLOCK_SOURCES", 2), ("HELD_CELLS", 10)):
        monkeypatch.setattr(divergence, name, value)
    rng = np.random.default_rng(3)
    rows = [
        (" ".join(f"w{'abcdefghij'[x % 10]}{'klmno'[x // 10]}" for x in rng.integers(0, 50, 12)), "en", f"s{k % 5}")
        for k in range(300)
    ]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    assert spark_audit(df, min_docs=3) == audit_by_hand(rows, 3)


def test_shares_are_exact_for_large_counts():
    total = 7_000_000_000_000_003
    n = np.array([0, 1, 999_999_999_999_989, total], np.int64)
    got = divergence.shares(n[None, :], np.full(4, total + 5 * 3))
    assert got[0].tolist() == [1 + 10**9 * (int(x) + 5) // (total + 15) for x in n]


def mine_by_hand(rows, every=100):
    ok = [
        (i, lab, [int(np.floor(256 * float(x))) for x in v])
        for i, v, lab in rows
        if i is not None and lab is not None and v is not None
        and all(x is not None and np.isfinite(x) for x in v)
    ]

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    for i, lab, v in ok:
        if i % every:
            continue
        scored = [(-dot(v, w), j, m) for j, m, w in ok if j != i]
        positives = sorted((s, j) for s, j, m in scored if m == lab)[:5]
        for s, j in positives:
            inside = sorted((t, k) for t, k, m in scored if m != lab and 30 * -s <= 100 * -t <= 90 * -s)[:10]
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(inside, 1)]
    return sorted(out)


def spark_mine(df, **kw):
    return sorted(tuple(r) for r in negatives.mine(df, **kw).collect())


VECTORS = "vec_id long, embedding array<double>, label int, rank int, `x.y` string"


def vector_rows(seed, n=400, dims=6, scale=1.0):
    rng = np.random.default_rng(seed)
    rows = [(k, (scale * rng.normal(0.2, 1, dims)).round(2).tolist(), int(rng.integers(0, 4))) for k in range(n)]
    rows += [(n + k, rows[5][1], k % 3) for k in range(60)]  # one very common vector
    rows += [(n + 100, None, 1), (n + 101, [1.0] * dims, None), (None, [1.0] * dims, 1)]
    rows += [(n + 102, [float("nan")] + [1.0] * (dims - 1), 1), (n + 103, [None] + [1.0] * (dims - 1), 1)]
    return rows + [(n + 104, [float("inf")] * dims, 1), (n + 105, [], 2), (n + 106, [3.0], 2)]


@pytest.mark.parametrize("scale", [1.0, 300.0])
def test_negatives_equal_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(negatives, "LEAST_ROWS", 50)
    monkeypatch.setattr(negatives, "BLOCK", 3)
    rows = vector_rows(7, scale=scale)
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], VECTORS)
    assert spark_mine(df, every=20) == mine_by_hand(rows, 20)
    assert spark_mine(df.limit(0)) == []
    assert spark_mine(df.where("vec_id % 20 <> 0"), every=20) == []


def test_negatives_of_several_groups(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS_PER_CELL", 8)
    monkeypatch.setattr(negatives, "ROWS_PER_CELL", 100)
    rows = vector_rows(11)
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], VECTORS)
    assert spark_mine(df, every=10) == mine_by_hand(rows, 10)


@pytest.mark.parametrize("dims, size", [(1, 3), (64, 256), (64, 1 << 20), (3000, 900), (5, 1 << 28)])
def test_residue_scores_are_exact(dims, size):
    rng = np.random.default_rng(dims)
    a, b = (rng.integers(-size, size + 1, (9, dims)) for _ in range(2))
    a[0], b[0], b[1] = size, size, -size
    primes = negatives.choose_primes(dims, dims * size * size)
    got = negatives.Residues(a.astype(float), primes).scores(negatives.Residues(b.astype(float), primes), 0, 9)
    assert got.astype(object).tolist() == (a.astype(object) @ b.astype(object).T).tolist()


def test_huge_components_are_held(spark):
    rows = [(k, [1e300 if k % 2 else -1e300, 1.0], k % 2) for k in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert negatives.mine(df, every=2).count() == 0
    assert negatives.matrix(pd.Series([[1e300]]), 1)[0, 0] ** 2 < 2**63
