"""The quality classifier: features, updates, cases and held-out accuracy."""

import numpy as np

from conftest import SF_MID
from flotilla.llm import quality
from flotilla.llm.queries import QUERIES


def test_features_are_unit_vectors_and_independent_of_the_slice():
    texts = [b"Some words, some WORDS!! 12 34", b"", b"   ", "é é é".encode(), b"x" * 100_000, b"a | b | c"]
    feature, value, n = quality.features(texts)
    at = np.concatenate([[0], np.cumsum(n)])
    for i, t in enumerate(texts):
        f, v, k = quality.features([t])
        assert (f == feature[at[i]:at[i + 1]]).all() and (v == value[at[i]:at[i + 1]]).all()
        assert k[0] == 0 or abs((v.astype(float) ** 2).sum() - 1) < 1e-5
    assert n[1] == n[2] == 0


def test_updates_match_the_textbook_loop():
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(50, 6, False)).astype(np.uint32), rng.random(6).astype(np.float32), int(rng.random() < .5)) for _ in range(40)]
    w, bias = quality.train(rows, epochs=2, seed=1)
    z, n, order = {}, {}, np.random.default_rng(1)

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= quality.L1 and i != "bias":
            return 0.0
        return -(zi - np.sign(zi) * quality.L1 * (abs(zi) > quality.L1)) / ((quality.BETA + n.get(i, 0.0) ** .5) / quality.ALPHA + quality.L2)
    for _ in range(2):
        for r in order.permutation(len(rows)):
            x = dict(zip(rows[r][0].tolist(), rows[r][1].astype(float))) | {"bias": 1.0}
            old = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(old[i] * x[i] for i in x)))
            for i in x:
                g = (p - rows[r][2]) * x[i]
                s = ((n.get(i, 0.0) + g * g) ** .5 - n.get(i, 0.0) ** .5) / quality.ALPHA
                z[i], n[i] = z.get(i, 0.0) + g - s * old[i], n.get(i, 0.0) + g * g
    assert abs(bias - weight("bias")) < 1e-6
    assert all(abs(w[i] - weight(i)) < 1e-5 for i in range(50))


def test_cases(spark):
    good, bad = "A plain sentence with words in it.", "BUY!! NOW!! CHEAP!! BUY!!"
    rows = [(i, good if i % 2 else bad) for i in range(40)] + [(40, None), (41, ""), (None, good), (42, "w " * 200_000), (1, good)]
    docs = spark.createDataFrame([(t, i, 0.1) for i, t in rows], "text string, doc_id long, score double").repartition(3)
    marks = [(i, i % 2) for i in range(40)] + [(40, 1), (41, 1), (5, 1), (99, 0), (None, 1), (6, None), (8, 7)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = quality.fit(docs, labels, max_epochs=30)
    assert 40 <= model.rows <= 43
    out = quality.score(docs, model)
    assert out.select("row.*").columns == docs.columns and out.count() == len(rows)
    got = {(r.row.doc_id, r.row.text): r.score for r in out.collect()}
    assert all(0 <= s <= 1 for s in got.values())
    assert min(s for (_, t), s in got.items() if t == good) > 0.5 > max(s for (_, t), s in got.items() if t == bad)
    assert got[40, None] == got[41, ""] == 1 / (1 + np.exp(-model.bias))
    small = quality.fit(docs, labels, max_rows=10)
    assert 0 < small.rows < 30
    none = quality.fit(docs, labels.limit(0))
    assert none.rows == 0 and {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    got = QUERIES["op9_quality"](spark, SF_MID).collect()
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    held = [r for r in got if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r.predicted == (r.score >= 0.3) for r in got)
