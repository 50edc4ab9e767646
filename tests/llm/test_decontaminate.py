"""Benchmark decontamination against brute force."""

import random
import re

import numpy as np

from conftest import SF_MID
from flotilla.llm import decontaminate as D, text as T
from flotilla.llm.queries import QUERIES


def terms(t):
    return re.findall(r"[^\x00-/:-@\[-`{-\x7f]+", (t or "").encode().lower().decode())


def scores(items, passage):
    """BM25 of each item for a passage's distinct terms, over its score for itself."""
    docs = [terms(x) for x in items]
    mean = sum(map(len, docs)) / len(docs)
    out = []

    def part(d, t):
        df = sum(t in x for x in docs)
        tf = d.count(t)
        return np.log1p((len(docs) - df + .5) / (df + .5)) * tf * (D.K1 + 1) / (tf + D.K1 * (1 - D.B + D.B * len(d) / mean))
    for d in docs:
        out.append(sum(part(d, t) for t in set(passage) if t in d) / sum(part(d, t) for t in set(d)))
    return out


def test_retrieves_all_over_the_threshold():
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(120)] + ["the", "of"] * 20
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 40))) for _ in range(50)]
    index = D.build([(i, t, None) for i, t in enumerate(items)])
    texts = []
    for _ in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 300))]
        for item in rng.sample(items, 2):
            at = rng.randrange(len(words) + 1)
            words[at:at] = item.split()[:rng.randrange(1, 40)]
        texts.append(" ".join(words))
    hashes, counts = T.words([t.encode() for t in texts], T.TERMS)
    for threshold in (0.3, 0.6):
        window, item, score, begin, end, owner = D.retrieve(index, hashes, counts, threshold)
        got = {(int(w), int(i)): s for w, i, s in zip(window, item, score)}
        starts = np.cumsum(counts) - counts
        want = {}
        for w in range(len(owner)):
            passage = terms(texts[owner[w]])[begin[w] - starts[owner[w]]:end[w] - starts[owner[w]]]
            want |= {(w, i): s for i, s in enumerate(scores(items, passage)) if s >= threshold}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_windows_hold_every_item_whole():
    index = D.build([(0, " ".join(f"a{i}" for i in range(45)), None)])
    item = [f"a{i}" for i in range(45)]
    for at in range(0, 400, 7):
        words = [f"z{i}" for i in range(at)] + item + [f"y{i}" for i in range(500 - at)]
        assert [m["question_overlap"] for m in D.matches(index, [" ".join(words).encode()], 0.5, 0.6)[0]] == [1.0]


ITEMS = [(1, "What is the largest moon of the planet Saturn, please?", "Titan it is"), (2, "Short one", None), (3, None, "only an answer here now"), (4, "!!", ""), (5, None, None), (None, "no id at all here", None)]


def run(spark, texts, **kw):
    docs = spark.createDataFrame([(t, i, "m") for i, t in texts], "text string, doc_id long, matches string").repartition(2)
    items = spark.createDataFrame(ITEMS, "item_id long, question string, answer string")
    out = D.contamination(docs, items, question_col="question", answer_col="answer", **kw)
    assert out.select("row.*").columns == docs.columns
    return sorted(((r.row.doc_id, [m.item_id for m in r.matches]) for r in out.collect()), key=repr)


def test_questions_answers_and_cases(spark):
    long = "filler " * 5000
    texts = [(1, "x WHAT is the largest moon of the planet Saturn please y... titan; it IS z"), (2, "What is the largest moon of the planet Saturn, please? nobody knows"),
             (3, "a short one"), (4, long + ITEMS[0][1] + " Titan it is " + long), (5, None), (6, ""), (7, "!! no id at all here"), (8, "Only an answer here now"),
             (None, "short one"), (1, "short one"), (1, "short one")]
    want = [(1, [1]), (2, []), (3, [2]), (4, [1]), (5, []), (6, []), (7, []), (8, [3]), (None, [2]), (1, [2]), (1, [2])]
    assert run(spark, texts) == sorted(want, key=repr)
    assert run(spark, texts, shard_bytes=40) == sorted(want, key=repr)  # several indexes in turn
    assert run(spark, []) == []
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.matches for r in D.contamination(docs, none).collect())


def test_changed_items_are_found(spark):
    """Case, punctuation, line breaks, one word in ten changed, a part left out."""
    rng = random.Random(6)
    words = [f"{rng.choice('abcdefgh')}{i}" for i in range(200)]
    items = [" ".join(words[i:i + 40]) + "." for i in range(0, 200, 40)]
    own = items[2].split()
    texts = [" ".join(own).upper(), "\n".join(own), ", ".join(own), " ".join("x" if i % 10 == 9 else w for i, w in enumerate(own)), " ".join(own[:25]),
             " ".join(own[:8]), " ".join(rng.sample(own, len(own)))]
    index = D.build([(i, t, None) for i, t in enumerate(items)])
    pad = " ".join(f"z{i}" for i in range(90))
    got = [[m["item_id"] for m in r] for r in D.matches(index, [f"{pad} {t} {pad}".encode() for t in texts], 0.4, 0.4)]
    assert got == [[2]] * 5 + [[], []]  # eight words, or all in another order, are no leak


def test_results_do_not_depend_on_the_parts(spark):
    """Partial copies, repeated items and documents: the same items, scores and overlaps from 1, 2 and many parts,
    and the scores of the brute force over the whole benchmark."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 30
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(6, 60)))) for i in range(200)]
    items += [items[3], items[3], (500, items[4][1])]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(30)) + " " + " ".join(t.split()[:int(len(t.split()) * share)]) + " z" * rng.randrange(40)
             for _, t in rng.sample(items, 80) for share in (0.45, 0.6, 1)]
    texts += texts[:3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(4)

    def found(shard_bytes):
        out = D.contamination(docs, bench, threshold=0.4, min_overlap=0.2, shard_bytes=shard_bytes)
        return sorted((r.row.doc_id, m.item_id, m.score, m.question_overlap) for r in out.collect() for m in r.matches)
    total = sum(len(t) + 16 for _, t in items)
    one = found(1 << 20)
    assert one == found(total // 2 + 1) == found(total // 16) and len(one) > 200
    assert len(D.build_parts(bench.selectExpr("item_id AS id", "text AS question", "CAST(NULL AS STRING) AS answer"), total // 16)) >= 16
    best = {}
    index = D.build([(i, t, None) for i, t in items])
    for d, i, s, _ in one[:60]:
        words = terms(texts[d])
        starts = range(0, max(1, -(-len(words) // index.stride) - 1) * index.stride, index.stride)
        passages = [words[a:a + 2 * index.stride] for a in starts]
        at = next(k for k, x in enumerate(items) if x[0] == i)
        best[d, i] = max(scores([t for _, t in items], p)[at] for p in passages)
        assert abs(best[d, i] - s) < 1e-9


def test_query_finds_whole_items(spark):
    """On the fixture: every document that holds an item's words in a row is
    found with it, and nothing that shares under two fifths of its 5-grams."""
    docs = {r.doc_id: terms(r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    items = {r.item_id: terms(r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_decontaminate"](spark, SF_MID).collect()}
    grams = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for d, w in docs.items()}
    share = {}
    for j, w in items.items():
        own = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        share |= {(d, j): len(own & g) / len(own) for d, g in grams.items() if own & g}
    assert {k for k, x in share.items() if x == 1.0} <= got
    assert all(share.get(k, 0) >= 0.4 for k in got) and got
