"""The Jaccard join against brute force."""

import random

import numpy as np
import pytest

from flotilla.llm import jaccard, rtree
from conftest import SF_MID


def brute(rows):
    """{(id, text): (n, component)} over rows with distinct ids."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    by_gram = {}
    for i, s in sets.items():
        for g in s:
            by_gram.setdefault(g, []).append(i)
    pairs = {(a, b) for v in by_gram.values() for a in v for b in v if a < b}
    for a, b in pairs:
        inter = len(sets[a] & sets[b])
        if 100 * inter >= 80 * (len(sets[a]) + len(sets[b]) - inter):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def mutate(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(30))
    rows, i = [], 0
    for size in (1, 2, 3, 7, 40, 90):
        base = [f"b{size}x{rng.randrange(5000)}" for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(size):
            rows.append((i, mutate(rng, base, rng.randrange(5))))
            i += 1
    for _ in range(30):
        rows.append((i, passage + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(3, 60)))))
        i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, " \t\n"), (i + 3, "one two"), (i + 4, "ONE  two"), (i + 5, "one two three"), (i + 6, "É é É é É é")]
    rows += [(i + 7 + k, rows[k * 3][1]) for k in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [2000, 8])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_NODES", block)
    monkeypatch.setattr(jaccard, "NOTED", 4)
    rows = corpus(block)
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, node string, tok string").repartition(5)
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_fixture_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    assert got == brute(rows)


def test_nulls_repeats_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(None, text), (None, None), (4, text), (4, text), (9, text), (5, None)], "doc_id long, text string")
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, 16, None), (None, 0, None), (4, 16, 4), (4, 16, 4), (9, 16, 4), (5, 0, 5)], key=repr)
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.comp for r in jaccard.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}


def test_tree_loses_no_similar_pair():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, rng.integers(5, 900)).astype(np.uint64) * np.uint64(2)
        for _ in range(5):
            keep = base[rng.random(len(base)) > rng.choice([0, .02, .1])]
            sets.append(np.unique(keep if len(keep) else base))
    n = np.array([len(s) for s in sets])
    points = rtree.as_bounds(rtree.count_vectors(np.concatenate(sets), n))
    tree = rtree.RTree(points, n)
    passed = 0
    for i, s in enumerate(sets):
        found = set(tree.query(points[i], int(n[i])).tolist())
        passed += len(found)
        for j, t in enumerate(sets):
            inter = len(np.intersect1d(s, t))
            if 100 * inter >= 80 * (n[i] + n[j] - inter):
                assert j in found
    assert passed < len(sets) ** 2 / 4


def test_frequent_groups_saturate():
    sets = np.sort(np.arange(40_000, dtype=np.uint64) << np.uint64(40))
    v = rtree.as_bounds(rtree.count_vectors(sets, np.array([len(sets)])))
    assert np.isinf(v).any()


def test_prefixes_lose_no_similar_pair():
    """Any two similar sets share enough shingles of their long prefixes, and one
    of the smaller's index prefix in the larger's plain prefix."""
    rng = np.random.default_rng(5)
    noted = rng.integers(0, 1 << 63, 50).astype(np.uint64)
    order = jaccard.Order(noted)
    for n in [*range(1, 60), 100, 333, 1000]:
        for _ in range(6):
            shared = rng.integers(0, 1 << 63, n).astype(np.uint64)
            shared[:min(n, 10)] = noted[:min(n, 10)]
            extra = rng.integers(0, n // 8 + 1)
            other = rng.integers(0, n // 8 + 1)
            a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, k).astype(np.uint64)])) for k in (extra, other))
            inter = len(np.intersect1d(a, b))
            if 100 * inter < 80 * (len(a) + len(b) - inter):
                continue
            if len(a) > len(b):
                a, b = b, a
            p, q = order.prefixes(np.concatenate([a, b]), np.array([len(a), len(b)]))
            x, y = a[p], b[q - len(a)]
            assert len(np.intersect1d(x, y)) >= max(jaccard.least_shared(len(a)), jaccard.least_shared(len(b)))
            assert len(np.intersect1d(x[:jaccard.index_length(len(a))], y[:jaccard.probe_length(len(b))])) >= jaccard.least_common(len(a))
