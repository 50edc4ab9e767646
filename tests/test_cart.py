"""Exact trees, bootstrap forests and cross-validation from moments, against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from flotilla.operators import cart as C
from flotilla.operators import evaluate as E
from flotilla.operators import models as M
from flotilla.operators.moments import cross_validate_linear
from flotilla.plans.studies import KEY, features_from, study_input
from flotilla.session import cut_lineage


def plain_tree(rows, asked, classify):
    """Recursive CART over (features, label, weight) rows, with plain lists and integers."""
    labels = sorted({r[1] for r in rows})

    def stat(part):
        n = sum(r[2] for r in part)
        sums = [sum(r[2] for r in part if r[1] == c) for c in labels] if classify else [sum(r[1] * r[2] for r in part)]
        return sum(s * s for s in sums) / n

    best = None
    if len(labels) > 1:
        for f in range(len(rows[0][0])):
            values = sorted({r[0][f] for r in rows})
            for a, b in zip(values, values[1:]):
                t = (a + b) / 2
                s = stat([r for r in rows if r[0][f] <= t]) + stat([r for r in rows if r[0][f] > t])
                if best is None or s > best[0] + 1e-12 * abs(s):
                    best = (s, f, t)
    if best is None:
        n = sum(r[2] for r in rows)
        count = {c: sum(r[2] for r in rows if r[1] == c) for c in labels}
        value = (sum(r[1] * r[2] for r in rows) / n, count.get(1, 0) / n, min(labels, key=lambda c: (-count[c], c)))
        return {a: value for a in asked}
    _, f, t = best
    return (plain_tree([r for r in rows if r[0][f] <= t], [a for a in asked if a[f] <= t], classify)
            | plain_tree([r for r in rows if r[0][f] > t], [a for a in asked if a[f] > t], classify))


def predicted(df, features):
    return {tuple(r[c] for c in features): (r["mean"], r["share_of_one"], r["top"]) for r in df.collect()}


def close(got, want):
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9), k


@pytest.fixture(scope="module")
def moto(spark):
    return cut_lineage(E.with_split(study_input(features_from(spark, SF_MID), "moto"), [KEY]))


@pytest.mark.parametrize("classify", [True, False])
@pytest.mark.parametrize("local_rows", [C.LOCAL_ROWS, 60])
def test_tree_equals_plain_cart_on_the_study(spark, moto, classify, local_rows):
    """The same predictions when a task grows the tree and when levels do."""
    train, test = moto.where("is_train"), moto.where("NOT is_train")
    f = M.MODEL_FEATURES
    rows = [(tuple(float(r[c]) for c in f), float(r.numTrips), 1) for r in train.collect()]
    asked = {tuple(float(r[c]) for c in f) for r in test.collect()}
    close(predicted(C.predict(train, test, f, "numTrips", classify, local_rows=local_rows), f), plain_tree(rows, asked, classify))


def test_levels_alone_and_edge_rows(spark):
    """Only levels (no local nodes), equal rows with different labels, a constant feature, many classes."""
    rng = random.Random(1)
    rows = [(float(rng.randrange(6)), 5.0, float(rng.randrange(4)), float(rng.choice([0, 1, 1, 2, 130]))) for _ in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    ask = spark.createDataFrame([(float(a), 5.0, float(c)) for a in range(-1, 8) for c in (0, 2.5, 9)], "a double, b double, c double")
    for classify in (True, False):
        want = plain_tree([((a, b, c), y, 1) for a, b, c, y in rows], {tuple(r) for r in ask.collect()}, classify)
        for local_rows in (0, 25, 1000):
            close(predicted(C.predict(df, ask, ["a", "b", "c"], "y", classify, local_rows=local_rows), ["a", "b", "c"]), want)
    assert C.predict(df.limit(0), ask, ["a", "b", "c"], "y", True).count() == 0
    with pytest.raises(Exception, match="is NULL"):
        C.predict(df.withColumn("a", F.lit(None).cast("double")), ask, ["a", "b", "c"], "y", True).collect()


def test_deeper_than_thirty():
    """A label whose only useful split is at the end each time: one level a value."""
    n = 80
    x, y = np.arange(n, dtype=float)[:, None], np.array([(i * (i + 1)) ** 4 % 10007 for i in range(n)], float)
    got = C.grow(x, y, np.ones(n), x, False)
    assert (got[:, 0] == y).all()  # every row is its own leaf
    y = 2.0 ** np.arange(n)        # the largest value is split off each time: a tree of depth n - 1
    assert (C.grow(x, y, np.ones(n), x, False)[:, 0] == y).all()


def test_deep_by_levels(spark):
    df = spark.range(40).selectExpr("CAST(id AS double) AS x", "pow(2.0D, id) AS y")
    got = predicted(C.predict(df, df, ["x"], "y", False, local_rows=3), ["x"])
    assert {k[0]: v[0] for k, v in got.items()} == {float(i): 2.0 ** i for i in range(40)}  # some 37 levels


def plain_weight(key, tree):
    u = int(hashlib.md5(f"{tree}|{key}".encode()).hexdigest()[:8], 16)
    return sum(u >= t for t in C._POISSON)


def test_forest_is_reproducible_and_equals_plain_trees(spark, moto):
    train, test = moto.where("is_train"), moto.where("NOT is_train")
    f, trees = M.MODEL_FEATURES, 4
    got = predicted(C.predict(train, test, f, "numTrips", False, trees, [KEY]), f)
    again = predicted(C.predict(train.repartition(7), test.repartition(3), f, "numTrips", False, trees, [KEY], local_rows=80), f)
    close(again, got)
    asked = {tuple(float(r[c]) for c in f) for r in test.collect()}
    sums = {a: np.zeros(3) for a in asked}
    for t in range(trees):
        rows = [(tuple(float(r[c]) for c in f), float(r.numTrips), plain_weight(r[KEY], t)) for r in train.collect()]
        for a, v in plain_tree([r for r in rows if r[2]], asked, False).items():
            sums[a] += np.array(v) / trees
    close(got, {a: tuple(v) for a, v in sums.items()})


def test_bootstrap_weights_are_poisson(spark):
    w = [r.w for r in spark.range(20_000).select(C.bootstrap_weight(F.col("id").cast("string"), F.lit(3)).alias("w")).collect()]
    assert abs(np.mean(w) - 1) < 0.03 and abs(np.var(w) - 1) < 0.05 and abs(w.count(0) / len(w) - np.exp(-1)) < 0.01


@pytest.mark.parametrize("alpha", [0.0, 0.5])
def test_moments_equal_separate_fits(spark, moto, alpha):
    f = M.MODEL_FEATURES
    train = moto.where("is_train")
    got = {(r.repeat, r.fold): (r.n, r.neg_mae) for r in cross_validate_linear(train, f, "numTrips", [KEY], alpha=alpha).collect()}
    assert len(got) == 30
    for repeat in (0, 2):
        pdf = E.with_folds(train, [KEY], repeat=repeat).toPandas()
        x, y = pdf[f].to_numpy(float), pdf.numTrips.to_numpy(float)
        for fold in (0, 9):
            out = (pdf.fold == fold).to_numpy()
            m, my = x[~out].mean(0), y[~out].mean()
            w = np.linalg.solve((x[~out] - m).T @ (x[~out] - m) + alpha * np.eye(3), (x[~out] - m).T @ (y[~out] - my))
            mae = np.abs(y[out] - my - (x[out] - m) @ w).mean()
            assert got[repeat, fold] == (out.sum(), pytest.approx(-mae, abs=1e-9))
    some = spark.createDataFrame([("k", 1, 2, 3, 4)], f"{KEY} string, hour int, clusterId int, numAvailable int, numTrips int")
    assert cross_validate_linear(some, f, "numTrips", [KEY]).count() == 0  # nothing is left to fit on
