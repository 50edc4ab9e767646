"""The prefix trie against brute force and SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from flotilla.llm import prefix_trie as P
from flotilla.llm.queries import ORACLES, QUERIES
from oracle import compare, duck

SCHEMA = "text string, conv_id long, depth string, role string, turn long, words string"


def sequences(rows):
    """Conversation -> its turns in order; null ids left out."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in out.items()}


def borrowed(seqs, every=20, most=4):
    out = {}
    for c, turns in seqs.items():
        h = zlib.crc32(str(c).encode()) % most
        out[c] = seqs.get(c - c % every, [])[:h] + turns[h:]
    return out


def brute(seqs):
    members = defaultdict(list)
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, ms in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(ms) - 1) * words
    return sorted((min(ms), len(path), min(members[path[:-1]]) if path else -1, len(ms), children[path], leaves[path], saved[path],
                   hashlib.sha256(",".join(map(str, sorted(c for c in ms if len(seqs[c]) == len(path)))).encode()).hexdigest())
                  for path, ms in members.items())


def frame(spark, rows):
    return spark.createDataFrame([(x, c, "d", r, t, "w") for c, t, r, x in rows], SCHEMA)


def collected(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def trie(spark, rows, **kw):
    return collected(P.prefix_trie(P.turn_digests(frame(spark, rows)), **kw))


def random_rows(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(150):
        turns = [(t, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, "d  e\tf"])) for t in range(rng.randint(1, 5))]
        rows += [(c, t, r, x) for t, r, x in turns]
    rows += [(c, t, "user", f"first {t}") for c in range(200, 260) for t in range(6)]               # copies
    rows += [(300, t, "u", "x") for t in range(400)] + [(301, t, "u", "x") for t in range(397)]      # long ones that share
    rows += [(302, 7, "u", "same")] * 90 + [(303, None, "u", "same")] * 2 + [(303, 1, "", "")]       # repeated rows, no turn number
    rows += [(None, 1, "u", "x"), (304, 1, "ab", "c"), (305, 1, "a", "bc"), (306, 0, "u", "y" * 2_000_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("per_range, bits", [(1 << 18, 28), (60, 28), (25, 3)])
def test_against_brute_force(spark, per_range, bits):
    """Ranges that cut conversations, and a sketch that takes nearly all for shared."""
    rows = random_rows()
    assert trie(spark, rows, per_range=per_range, sketch_bits=bits) == brute(sequences(rows))


def test_borrowed_heads(spark):
    rng = random.Random(7)
    rows = [(c, t, "u", rng.choice("abc")) for c in range(130) if c not in (40, 60) for t in range(rng.randint(1, 6))]
    rows += [(100, t, "u", "z") for t in range(200)]
    turns = P.turn_digests(frame(spark, rows).repartition(3))
    conv = F.col("conv_id")
    out = P.with_borrowed_heads(turns, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, most=3)
    want = borrowed(sequences(rows))
    assert any(not t for t in want.values())                                                         # a turnless conversation
    assert collected(P.prefix_trie(*out, per_range=50)) == brute(want)


def test_few_and_none(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "u", "x")]) == []
    for rows in ([(5, 1, "u", "x y")], [(5, 1, None, None)], [(5, 1, "u", "x"), (4, 1, "u", "x")], [(2, 1, "u", "x"), (9, 1, "u", "x"), (9, 2, "u", "y")]):
        assert trie(spark, rows) == brute(sequences(rows))
    turns = P.turn_digests(frame(spark, []))
    only = spark.createDataFrame([(3,), (2,)], "conv_id long")
    assert collected(P.prefix_trie(turns, only)) == [(2, 0, -1, 2, 0, 1, 0, hashlib.sha256(b"2,3").hexdigest())]


def test_an_estimate_of_one_is_a_proof(spark):
    """No prefix that two rows share is ever single; nearly all others are."""
    rng = np.random.default_rng(0)
    values = rng.integers(-2 ** 63, 2 ** 63, (3000, 2))
    rows = np.concatenate([values, values[:500], values[:100]])
    df = spark.createDataFrame([tuple(map(int, r)) for r in rows], "p1 long, p2 long").repartition(5)
    for bits in (28, 12, 4):
        sketch = P.count_prefixes(df, len(rows), bits)
        single = sketch.single(values[:, 0].copy(), values[:, 1].copy())
        assert not single[:500].any()
        assert single[500:].mean() > {28: 0.95, 12: 0.2, 4: -1}[bits]


def test_tails_do_not_shuffle(spark):
    """Only rows under possibly shared prefixes are grouped."""
    rows = [(c, t, "u", f"{c} {t}") for c in range(200) for t in range(5)] + [(c, 0, "u", "hello") for c in range(1000, 1010)]
    turns = P.turn_digests(frame(spark, rows)).withColumn("part", F.lit(0))
    table = P.prefixes(turns)
    out = P.screen(table, P.count_prefixes(table, len(rows)))
    assert out.filter("NOT under AND NOT single").count() <= 20 and out.filter("under").count() >= 750


def test_query_against_sql_and_brute_force(spark):
    ok, why = compare(spark, duck(SF_MID), "op11_prefix_trie", QUERIES["op11_prefix_trie"], ORACLES["op11_prefix_trie"], SF_MID)
    assert ok, why
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op11_prefix_trie"](spark, SF_MID)) == brute(borrowed(sequences(rows)))
