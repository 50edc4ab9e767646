"""Hard negatives against brute force."""

import numpy as np
import pytest

from conftest import SF_MID
from flotilla.llm import negatives
from flotilla.llm.queries import ORACLES, QUERIES
from oracle import compare, duck


def brute(rows, anchors, positives=5, most=5, least=80):
    out, seen = [], set()
    for a, lab, vec in anchors:
        if a is None or lab is None or vec is None or (a, lab, tuple(vec)) in seen:
            continue
        seen.add((a, lab, tuple(vec)))
        scored = sorted((-sum(x * y for x, y in zip(vec, v)), i, la) for i, la, v in rows
                        if None not in (i, la, v) and i != a and len(v) == len(vec))
        for p in [s for s in scored if s[2] == lab][:positives]:
            hits = [s for s in scored if s[2] != lab and least * -p[0] <= 100 * -s[0] <= 100 * -p[0]][:most]
            out += [(a, p[1], r + 1, h[1], -p[0], -h[0]) for r, h in enumerate(hits)]
    return sorted(out)


def run(spark, rows, anchors, **kw):
    def frame(x):
        return spark.createDataFrame([(v, "s", i, la, 1) for i, la, v in x], "vec array<long>, stripe string, id long, label int, block int")
    return sorted(tuple(r) for r in negatives.hard_negatives(frame(rows), frame(anchors), **kw).collect())


@pytest.mark.parametrize("stripe_rows, block_rows", [(1 << 18, 256), (90, 7)])
def test_against_brute_force(spark, stripe_rows, block_rows):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 4)), rng.integers(-40, 90, 6).tolist()) for i in range(500)]
    rows += [(i, i % 2, [7, -2, 30, 4, 50, 6]) for i in range(500, 900)]             # a very common vector: all ties
    rows += [(i, 3, rng.integers(0, 9, 6).tolist()) for i in range(900, 1100)]       # a label with many rows
    rows += [rows[3], rows[3], (None, 1, [1] * 6), (2000, None, [1] * 6), (2001, 1, None)]
    rows += [(2010, 1, [1, 2]), (2011, 1, [2, 2]), (2012, 2, [1, 2]), (2013, 1, []), (2014, 1, []), (2015, 2, [])]
    anchors = [r for r in rows if r[0] is not None and r[0] % 10 == 0] + [rows[0], (2013, 1, []), (2010, 1, [1, 2])]
    got = run(spark, rows, anchors, stripe_rows=stripe_rows, block_rows=block_rows)
    assert got == brute(rows, anchors) and any(r[0] == 2013 for r in got) and any(r[0] == 2010 for r in got)


def test_nulls_few_rows_and_empty_tables(spark):
    rows = [(1, 1, [1, 2]), (2, 1, [2, 2]), (3, 2, [2, 1]), (4, 2, None), (None, 2, [2, 2])]
    assert run(spark, rows, rows) == brute(rows, rows)
    assert run(spark, rows, rows[:1]) == [] and run(spark, rows, rows[:1], least_percent=60) == [(1, 2, 1, 3, 6, 4)]
    assert run(spark, [], []) == [] and run(spark, rows, []) == [] and run(spark, [], rows) == []


@pytest.mark.parametrize("span, dim", [(1, 3), (90, 64), (4000, 9), (1 << 20, 5), (1 << 33, 4), (1 << 62, 3)])
def test_fields_hold_exact_scores(span, dim):
    rng = np.random.default_rng(span % 97)
    anchors, vectors = rng.integers(-span, span + 1, (7, dim)), rng.integers(-span, span + 1, (101, dim))
    pack = negatives.Pack.of(np.arange(101), np.arange(101) // 9, vectors, int(anchors.min()), int(anchors.max()))
    want = np.clip(anchors.astype(object) @ vectors.astype(object).T, -(2 ** 63), 2 ** 63 - 1).astype(np.int64)
    assert (pack.scores(anchors) == want).all() and (pack.scores(anchors, 13, 40) == want[:, 13:40]).all()
    assert pack.fields >= 2 or span > 4000


def test_packs_survive_their_file(tmp_path):
    for span in (50, 1 << 62):
        v = np.arange(12).reshape(4, 3) * (span // 12)
        pack = negatives.Pack.of(np.arange(4), np.zeros(4, np.int64), v, -span, span)
        pack.save(str(tmp_path / f"{span}.npz"))
        a = np.array([[1, -2, 3]])
        assert (negatives.Pack.load(str(tmp_path / f"{span}.npz")).scores(a) == v @ a[0]).all()


def test_query_against_sql(spark):
    ok, why = compare(spark, duck(SF_MID), "op13_negatives", QUERIES["op13_negatives"], ORACLES["op13_negatives"], SF_MID)
    assert ok and why != "0 rows", why
