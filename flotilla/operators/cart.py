"""Exact classification and regression trees, without a limit of depth or bins.

Every value of every feature is a split candidate. Trees grow by levels: the
rows of all nodes of all trees are counted per (tree, node, feature, value, label),
prefix sums over the values give every candidate's score, and each node takes its
best. Rows are first reduced to distinct (features, label) with a weight, and the
rows to predict go down the tree with them. A node of at most ``local_rows``
distinct rows is finished in one task (its whole subtree), so a level costs a job
only while nodes are larger than that.

Score of a split: sum of squared class weights (of squared label sums, for
regression) over the weight, left plus right; that is the least Gini impurity (squared
error). Ties go to the feature first in the list, then to the lower threshold, which
lies halfway between two values. A node is a leaf when its labels are equal or none of
its features varies.

Bagging carries a weight per (row, tree) that a hash of the row's key and the tree's
number draws from a Poisson distribution of mean 1, so a forest is the same for
any partitioning, and all its trees grow together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flotilla.operators.evaluate import round_half_even, row_key
from flotilla.session import cut_lineage

LOCAL_ROWS = 50_000
#: Cumulated Poisson(1) probabilities up to weight 7, in units of 2 ** -32.
_POISSON = [math.floor(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * 2 ** 32) for k in range(8)]


def bootstrap_weight(key: Column, tree: Column) -> Column:
    """How often a row is in a tree's sample: 0 to 8, 1 on average."""
    u = F.conv(F.substring(F.md5(F.concat(tree.cast("string"), F.lit("|"), key)), 1, 8), 16, 10).cast("long")
    return sum((F.when(u >= t, 1).otherwise(0) for t in _POISSON[1:]), F.when(u >= _POISSON[0], 1).otherwise(0))


# ------------------------------------------------------- a subtree in one task

def _best(x: np.ndarray, stat: np.ndarray, w: np.ndarray) -> tuple[int, float] | None:
    best, total, weight = None, stat.sum(axis=0), w.sum()
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, left, n = x[order, f], np.cumsum(stat[order], axis=0), np.cumsum(w[order])
        cut = np.flatnonzero(v[1:] != v[:-1])
        if len(cut):
            s = (left[cut] ** 2).sum(axis=1) / n[cut] + ((total - left[cut]) ** 2).sum(axis=1) / (weight - n[cut])
            at = int(np.argmax(s))
            if best is None or s[at] > best[0]:
                best = (s[at], f, (v[cut[at]] + v[cut[at] + 1]) / 2)
    return best and best[1:]


def _leaf(y: np.ndarray, w: np.ndarray) -> tuple[float, float, float]:
    """(mean, share of label 1, most frequent label; of equals the least)."""
    values, at = np.unique(y, return_inverse=True)
    n = np.bincount(at, w)
    return float((y * w).sum() / w.sum()), float(w[y == 1].sum() / w.sum()), float(values[np.argmax(n)])


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, ask: np.ndarray, classify: bool) -> np.ndarray:
    """Predictions (see :func:`_leaf`) for the rows ``ask`` of the tree of (x, y, w)."""
    out = np.zeros((len(ask), 3))
    values, at = np.unique(y, return_inverse=True)
    stat = np.eye(len(values))[at] * w[:, None] if classify else (y * w)[:, None]
    stack = [(np.arange(len(x)), np.arange(len(ask)))]
    while stack:
        rows, asked = stack.pop()
        if not len(asked):
            continue
        split = _best(x[rows], stat[rows], w[rows]) if (y[rows] != y[rows[0]]).any() else None
        if split is None:
            out[asked] = _leaf(y[rows], w[rows])
            continue
        f, threshold = split
        low, low_asked = x[rows, f] <= threshold, ask[asked, f] <= threshold
        stack += [(rows[low], asked[low_asked]), (rows[~low], asked[~low_asked])]
    return out


# ------------------------------------------------------------------- by levels

NODE = ["tree", "node"]


def candidates(rows: DataFrame, features: Sequence[str], classify: bool) -> DataFrame:
    """(tree, node, f, v, threshold, score): every split of every node of the
    weighted rows (tree, node, features.., y, w)."""
    long = (rows.select(*NODE, "y", "w", F.posexplode(F.array(*[F.col(c) for c in features])).alias("f", "v"))
            .groupBy(*NODE, "f", "v", "y").agg(F.sum("w").alias("k")))
    side = Window.partitionBy(*NODE, "f").orderBy("v")
    if classify:
        one = Window.partitionBy(*NODE, "f", "y").orderBy("v")
        # Moving weight k of a class with L to the left changes the sum of L^2 by 2Lk + k^2.
        step = (long.withColumn("L", F.sum("k").over(one) - F.col("k")).withColumn("T", F.sum("k").over(Window.partitionBy(*NODE, "f", "y")))
                .groupBy(*NODE, "f", "v").agg(F.sum("k").alias("k"), F.sum(2 * F.col("L") * F.col("k") + F.col("k") * F.col("k")).alias("sq"),
                                              F.sum(F.col("T") * F.col("k")).alias("tk")))
        step = step.select(*NODE, "f", "v", F.sum("k").over(side).alias("n"), F.sum("sq").over(side).alias("left"), F.sum("tk").over(side).alias("tl"),
                           F.lead("v").over(side).alias("next"))
        # At the last value all is left: sum of T^2 = sum of L^2 there.
        end = Window.partitionBy(*NODE, "f")
        step = step.withColumn("all", F.max("left").over(end)).withColumn("total", F.max("n").over(end))
        right = F.col("all") - 2 * F.col("tl") + F.col("left")
        score = F.col("left") / F.col("n") + right / (F.col("total") - F.col("n"))
    else:
        step = long.groupBy(*NODE, "f", "v").agg(F.sum("k").alias("k"), F.sum(F.col("y") * F.col("k")).alias("s"))
        end = Window.partitionBy(*NODE, "f")
        step = step.select(*NODE, "f", "v", F.sum("k").over(side).alias("n"), F.sum("s").over(side).alias("left"), F.sum("s").over(end).alias("all"),
                           F.sum("k").over(end).alias("total"), F.lead("v").over(side).alias("next"))
        right = F.col("all") - F.col("left")
        score = F.col("left") * F.col("left") / F.col("n") + right * right / (F.col("total") - F.col("n"))
    return step.where(F.col("next").isNotNull()).select(*NODE, "f", "v", ((F.col("v") + F.col("next")) / 2).alias("threshold"), score.cast("double").alias("score"))


def _best_of(splits: DataFrame) -> DataFrame:
    best = F.max_by(F.struct("f", "threshold"), F.struct("score", -F.col("f"), -F.col("threshold")))
    return splits.groupBy(*NODE).agg(best.alias("b")).select(*NODE, "b.f", "b.threshold")


def predict(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, classify: bool,
            trees: int = 1, key_cols: Sequence[str] | None = None, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """(features.., mean, share_of_one, top): predictions of one tree, or the mean of a
    forest's, for each distinct feature row of ``test``. With ``key_cols`` the trees'
    training rows are weighted by :func:`bootstrap_weight`, else each counts once.

    Features and labels are numbers; a NULL fails the study. A tree whose sample is empty
    has no prediction; an empty training table gives none at all.
    """
    def number(c: str) -> Column:
        return F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is NULL")).cast("double")).otherwise(F.col(c).cast("double"))

    x = [f"_x{i}" for i in range(len(features))]
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    weight = bootstrap_weight(row_key(key_cols), F.col("tree")) if key_cols else F.lit(1)
    keys = [c for c in (key_cols or [])]
    rows = train.select(*keys, *[number(c).alias(n) for c, n in zip(features, x)], number(label).alias("y"), tree)
    rows = rows.groupBy("tree", *x, "y").agg(F.sum(weight).alias("w")).where("w > 0")
    asked = test.select(*[number(c).alias(n) for c, n in zip(features, x)]).distinct().select(tree, *x, F.lit(None).cast("double").alias("y"), F.lit(0).cast("long").alias("w"))
    at = cut_lineage(rows.unionByName(asked).withColumn("node", F.lit("")), "cart-rows")
    done: list[DataFrame] = []
    while True:
        learn = F.col("w") > 0
        varies = [F.coalesce(F.min(F.when(learn, F.col(c))) < F.max(F.when(learn, F.col(c))), F.lit(False)) for c in x]
        impure = F.coalesce(F.min("y") < F.max("y"), F.lit(False))
        state = at.groupBy(*NODE).agg(F.count(F.lit(1)).alias("size"), F.count_if(learn).alias("n"), F.count_if(~learn).alias("asked"),
                                      (impure & F.greatest(*varies) if len(x) > 1 else impure & varies[0]).alias("open"))
        state = cut_lineage(state.where("asked > 0 AND n > 0"), "cart-nodes")  # nodes that nobody asks for don't grow
        split = state.where((F.col("size") > local_rows) & F.col("open")).select(*NODE)
        here = at.join(state.where((F.col("size") <= local_rows) & F.col("open")).select(*NODE), NODE, "left_semi")
        leaves = at.join(state.where(~F.col("open")).select(*NODE), NODE, "left_semi")
        done += [_finished(here, x, classify), _leaves(leaves, x)]
        if split.isEmpty():
            break
        open_rows = at.join(split, NODE, "left_semi")
        best = _best_of(candidates(open_rows.where(learn), x, classify))
        side = F.when(F.get(F.array(*x), F.col("f")) <= F.col("threshold"), F.lit("l")).otherwise(F.lit("r"))
        at = cut_lineage(open_rows.join(best, NODE).withColumn("node", F.concat("node", side)).select("tree", "node", *x, "y", "w"), "cart-rows")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.groupBy(*x).agg(*[F.avg(c).alias(c) for c in ("mean", "share_of_one", "top")]).select(
        *[F.col(n).alias(c) for n, c in zip(x, features)], "mean", "share_of_one", "top")


def predict_rows(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, kind: str,
                 key_cols: Sequence[str], trees: int = 10, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """The rows of ``test`` with Real and Prediction. kind 'exact_tree': the share of
    label 1 in the leaf, rounded half to even; 'exact_tree_class': its most frequent
    label; 'exact_bagging': the mean of ``trees`` bootstrap trees' means."""
    forest = kind == "exact_bagging"
    found = predict(train, test, features, label, not forest, trees if forest else 1, key_cols if forest else None, local_rows)
    value = {"exact_tree": round_half_even(F.col("share_of_one")), "exact_tree_class": F.col("top"), "exact_bagging": F.col("mean")}[kind]
    found = found.select(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(features)], value.alias("Prediction"))
    same = [F.col(c).cast("double") == F.col(f"_f{i}") for i, c in enumerate(features)]
    joined = test.join(found, same, "left").withColumn("Real", F.col(label).cast("double"))
    return joined.select(*test.columns, "Real", "Prediction")


def _finished(rows: DataFrame, x: list[str], classify: bool) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        learn = pdf.w.to_numpy() > 0
        points = pdf[x].to_numpy(np.float64)
        order = np.lexsort((pdf.y[learn], *points[learn].T[::-1]))  # sums don't depend on the order of arrival
        got = grow(points[learn][order], pdf.y[learn].to_numpy(np.float64)[order], pdf.w[learn].to_numpy(np.float64)[order], points[~learn], classify)
        return pd.DataFrame(np.hstack([points[~learn], got]), columns=[*x, "mean", "share_of_one", "top"]).assign(tree=int(pdf.tree.iloc[0]))
    return rows.groupBy(*NODE).applyInPandas(run, ", ".join(f"{c} double" for c in (*x, "mean", "share_of_one", "top")) + ", tree int")


def _leaves(rows: DataFrame, x: list[str]) -> DataFrame:
    learn = rows.where("w > 0").groupBy(*NODE, "y").agg(F.sum("w").alias("n"))
    value = learn.groupBy(*NODE).agg((F.sum(F.col("y") * F.col("n")) / F.sum("n")).alias("mean"), (F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("share_of_one"),
                                     F.max_by("y", F.struct("n", -F.col("y"))).alias("top"))
    return rows.where("w = 0").join(value, NODE).select(*x, "mean", "share_of_one", "top", F.col("tree").cast("int"))
