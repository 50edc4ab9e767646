"""Exact top-k against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.llm import topk
from flotilla.llm.queries import QUERIES


def brute(rows, queries, k):
    out = []
    for qi, q in queries:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in rows if i != qi and len(v) == len(q))
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, queries, **kw):
    def frame(x):
        return spark.createDataFrame([(v, i, "d") for i, v in x], "vec array<long>, id long, dim string")
    return sorted(tuple(r) for r in topk.top_k(frame(rows), frame(queries), **kw).collect())


@pytest.mark.parametrize("shard_rows", [10_000, 70])
def test_against_brute_force(spark, shard_rows):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.integers(-9, 10, 6).tolist()) for i in range(400)]
    rows += [(int(i), [1, 2, 3, 4, 5, 6]) for i in range(400, 600)]        # one very common vector: all ties
    rows += [(5, rows[3][1]), (700, [1, 2]), (701, [2, 2]), (702, []), (703, [10 ** 9] * 6), (704, [-(10 ** 9)] * 6), (705, [0] * 6)]
    queries = [r for r in rows if r[0] % 20 == 0 or r[0] in (703, 704)] + [(702, [])]
    assert run(spark, rows, queries, k=20, shard_rows=shard_rows, block_rows=16) == brute(rows, queries, 20)


def test_nulls_few_rows_and_empty_tables(spark):
    rows = [(1, [1, 2]), (2, None), (None, [5, 5]), (3, [2, 2])]
    assert run(spark, rows, rows) == [(1, 1, 3, 6), (3, 1, 1, 6)]
    assert run(spark, [], []) == [] and run(spark, rows, []) == [] and run(spark, [], rows) == []


def test_tree_is_tight_and_prunes():
    rng = np.random.default_rng(0)
    centres = rng.integers(-100, 100, (40, 8))
    points = np.concatenate([c + rng.integers(-2, 3, (100, 8)) for c in centres])
    tree = topk.build(np.arange(len(points)), points)
    for a, b, lo, hi in zip(tree.begin, tree.end, tree.lo, tree.hi):
        assert (tree.points[a:b].min(axis=0) == lo).all() and (tree.points[a:b].max(axis=0) == hi).all()
    best = [topk.Best(5)]
    leaves = (tree.left < 0).sum()
    assert topk.search(tree, points[:1], np.array([0]), best) < leaves / 4
    score = points @ points[0]
    assert best[0].score.tolist() == sorted(np.delete(score, 0))[::-1][:5]
    first = best[0].kth  # a second tree starts from the k-th score of the first
    far = topk.build(np.arange(10_000, 10_100), np.full((100, 8), -1) * np.sign(points[0]))
    assert topk.search(far, points[:1], np.array([0]), best) == 0 and best[0].kth == first


def test_trees_that_cannot_beat_the_kth_score_are_not_loaded(spark, monkeypatch):
    """Clusters far apart: a block of one cell loads few trees; extra columns don't clash."""
    rng = np.random.default_rng(5)
    centres = rng.choice([-100, 100], (16, 8))
    v = np.concatenate([c + rng.integers(-3, 4, (60, 8)) for c in centres])
    rows = [(i, x) for i, x in enumerate(v.tolist())]
    written = []
    monkeypatch.setattr(topk, "fresh_path", lambda spark, label, real=topk.fresh_path: written.append(real(spark, label)) or written[-1])
    frame = spark.createDataFrame([(i, x, 1, 2, 3, 4) for i, x in rows], "id long, vec array<long>, cell int, part int, dim int, file int")
    got = topk.top_k(frame, frame.filter("id % 20 = 0"), k=5, shard_rows=60, block_rows=16)
    assert sorted(map(tuple, got.collect())) == brute(rows, rows[::20], 5)
    trees = written[1]
    files = spark.read.parquet(trees).count()
    loaded = []
    block = pd.DataFrame({"dim": 8, "id": [0, 20], "vec": [rows[0][1], rows[20][1]]})
    own, _, best = topk._search_all(block, trees, 5, load=lambda name: loaded.append(name) or topk.Tree.load(name))
    assert files >= 8 and len(set(loaded)) == len(loaded) <= files // 2
    assert [b.id.tolist() for b in best] == [[i for q, _, i, _ in brute(rows, [rows[o]], 5)] for o in own]


def test_integer_vectors(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([([0.5, -0.001, 1.0],), ([nan],), ([inf],), ([-inf],), ([None],), (None,), ([],)], "v array<float>")
    got = [r[0] for r in df.select(topk.integer_vectors(F.col("v"))).collect()]
    assert got == [[32, -1, 64], None, None, None, None, None, []]


def test_query_against_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in table])
    v = np.floor(np.array([r.embedding for r in table], np.float64) * 64).astype(np.int64)
    want = []
    for i in np.flatnonzero(ids % 20 == 0):
        score = v @ v[i]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:20]
        want += [(int(ids[i]), r + 1, int(ids[j]), int(score[j])) for r, j in enumerate(order)]
    assert sorted(tuple(r) for r in QUERIES["op1_topk"](spark, SF_SMALL).collect()) == sorted(want)
