"""Length buckets and batches."""

import random
from itertools import combinations

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.llm import packing
from flotilla.llm.queries import QUERIES


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 60), st.integers(1, 50), min_size=1, max_size=9), st.integers(1, 5))
def test_bounds_are_optimal(histogram, buckets):
    lengths, counts = list(histogram), list(histogram.values())
    top, rest = max(lengths), sorted(set(lengths) - {max(lengths)})
    best = min(packing.padding(lengths, counts, [*c, top]) for k in range(min(buckets, len(lengths))) for c in combinations(rest, k))
    bounds = packing.bucket_bounds(lengths, counts, buckets)
    assert bounds == sorted(set(bounds)) and len(bounds) <= buckets and bounds[-1] == top
    assert packing.padding(lengths, counts, bounds) == best


def test_many_lengths():
    rng = random.Random(1)
    lengths = rng.sample(range(100_000), 3000)
    counts = [rng.randrange(1, 1000) for _ in lengths]
    costs = [packing.padding(lengths, counts, packing.bucket_bounds(lengths, counts, k)) for k in (1, 2, 4, 16, 64, 3000)]
    assert costs == sorted(costs, reverse=True) and costs[-1] == 0
    assert packing.bucket_bounds([], [], 4) == []


@pytest.mark.parametrize("part_rows", [50_000, 25])
def test_batches(spark, part_rows):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 3, 5, 90, 91, 400])) for i in range(300)] + [(1, 3), (1, 3), (None, 7), (None, None), (999, 10_000)]
    df = spark.createDataFrame([(n, i, 0) for i, n in rows], "n int, doc_id long, bucket int").repartition(4)
    got = packing.pack(df, F.col("n"), buckets=4, token_budget=1000, part_rows=part_rows).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=repr) == sorted(((i, n or 0) for i, n in rows), key=repr)
    bounds = sorted({r.bucket_tokens for r in got})
    assert bounds == [b for b in packing.bucket_bounds(sorted({n or 0 for _, n in rows}), [sum((m or 0) == n for _, m in rows) for n in sorted({n or 0 for _, n in rows})], 4)]
    batches = {}
    for r in got:
        assert r.bucket_tokens == min(b for b in bounds if b >= r.n_tokens)
        batches.setdefault((r.bucket_tokens, r.batch_id), []).append(r.slot)
    for bound in bounds:
        capacity = max(1, 1000 // max(1, bound))
        mine = [sorted(s) for (b, _), s in batches.items() if b == bound]
        assert all(s == list(range(len(s))) for s in mine)
        assert sorted(map(len, mine))[1:] == [capacity] * (len(mine) - 1) and max(map(len, mine)) <= capacity
    assert len({k[1] for k in batches}) == len(batches)


def test_equal_rows_spread_over_parts(spark, monkeypatch):
    """Half of the rows without an id and empty: no part is much larger than asked."""
    seen = {}
    real = packing.cut_lineage
    monkeypatch.setattr(packing, "cut_lineage", lambda df, label: seen.setdefault(label, real(df, label)))
    df = spark.range(40_000).selectExpr("if(id % 2 = 0, NULL, id) AS doc_id", "if(id % 2 = 0, 0, id % 50) AS n")
    got = packing.pack(df, F.col("n"), part_rows=1000, token_budget=64)
    assert got.count() == 40_000 and got.select("batch_id", "slot").distinct().count() == 40_000
    offsets = seen["pack-offsets"].orderBy("_bucket", "_part").collect()
    assert max(b._offset - a._offset for a, b in zip(offsets, offsets[1:]) if a._bucket == b._bucket) < 1000


@pytest.mark.parametrize("name", ["n_tokens", "slot", "batch_id", "bucket_tokens", "_id", "_row"])
def test_clashing_names(spark, name):
    df = spark.createDataFrame([(7, 3, "x"), (8, 2, "y")], f"`{name}` long, n int, other string")
    got = packing.pack(df, F.col("n"), id_col=name)
    assert len(set(got.columns)) == 5 and sorted((r[0], r.n_tokens) for r in got.collect()) == [(7, 3), (8, 2)]


def test_empty_table_and_words(spark):
    df = spark.createDataFrame([(1, " a\tb\x0bc d \n"), (2, ""), (3, None)], "doc_id long, text string")
    assert [r[0] for r in df.select(packing.word_count(F.col("text"))).collect()] == [3, 0, 0]
    assert packing.pack(df.limit(0), packing.word_count(F.col("text"))).count() == 0


def test_query(spark):
    docs = {r.doc_id: len(r.text.encode().split()) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op4_packing"](spark, SF_SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in got} == docs and len(got) == len(docs)
    counts = [list(docs.values()).count(n) for n in sorted(set(docs.values()))]
    assert sorted({r.bucket_tokens for r in got}) == packing.bucket_bounds(sorted(set(docs.values())), counts, 16)
