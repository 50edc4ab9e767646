"""Cross-validated linear fits from fold moments.

Least squares needs of its training rows only their Gram matrix, and the rows
outside a fold are all rows minus the fold's. So one aggregate gives the moments
of every (repeat, fold), each fit is a small linear system made by subtraction,
and a second aggregate scores all of them: two passes over the rows whatever the
number of fits. The systems (repeats x folds, a few numbers each) are solved on
the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flotilla.operators.evaluate import CV_FOLDS, CV_REPEATS, hash_bucket, row_key


def _by_fold(df: DataFrame, key_cols: Sequence[str], folds: int, repeats: int) -> DataFrame:
    """Each row once per repeat, with its fold there (as ``evaluate.with_folds``)."""
    out = df.withColumn("_key", row_key(key_cols)).withColumn("repeat", F.explode(F.array(*[F.lit(r) for r in range(repeats)])))
    return out.withColumn("fold", hash_bucket(F.concat(F.col("repeat").cast("string"), F.lit("|"), F.col("_key")), folds).cast("int"))


def _solve(gram: np.ndarray, alpha: float) -> np.ndarray:
    """Intercept and weights from the moments of (1, x.., y); alpha penalises the weights."""
    n, p = gram[0, 0], len(gram) - 2
    mean = gram[0, 1:] / n
    cov = gram[1:, 1:] / n - np.outer(mean, mean)
    a = cov[:p, :p] + alpha / n * np.eye(p)
    w = np.linalg.lstsq(a, cov[:p, p], rcond=None)[0]  # least norm where a column is constant
    return np.concatenate([[mean[p] - w @ mean[:p]], w])


def cross_validate_linear(df: DataFrame, features: Sequence[str], label: str, key_cols: Sequence[str],
                          folds: int = CV_FOLDS, repeats: int = CV_REPEATS, alpha: float = 0.0) -> DataFrame:
    """(repeat, fold, n, neg_mae) of least squares (ridge with ``alpha``), fitted
    outside each fold and scored on it. Rows with a NULL label or feature fail the
    study; a fold without rows has no score, one that holds all rows none either."""
    spark = df.sparkSession
    cols = [F.col(c).cast("double") for c in (*features, label)]
    checked = [F.when(c.isNull(), F.raise_error(F.lit(f"{name} is NULL")).cast("double")).otherwise(c) for c, name in zip(cols, (*features, label))]
    rows = df.select(*key_cols, *[c.alias(f"_x{i}") for i, c in enumerate(checked)])
    p = len(cols)
    # Shifted by the means, so that subtracting moments loses no digits.
    shift = [float(v or 0.0) for v in rows.agg(*[F.avg(f"_x{i}") for i in range(p)]).first()]
    x = [F.lit(1.0)] + [F.col(f"_x{i}") - F.lit(s) for i, s in enumerate(shift)]
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    dealt = _by_fold(rows, key_cols, folds, repeats)
    found = dealt.groupBy("repeat", "fold").agg(*[F.sum(x[i] * x[j]).alias(f"m{i}_{j}") for i, j in pairs]).collect()  # repeats x folds rows
    grams = {}
    for r in found:
        g = np.zeros((p + 1, p + 1))
        for i, j in pairs:
            g[i, j] = g[j, i] = r[f"m{i}_{j}"]
        grams[r.repeat, r.fold] = g
    fits = []
    for r in range(repeats):
        whole = sum((g for (rr, _), g in grams.items() if rr == r), np.zeros((p + 1, p + 1)))
        for f in range(folds):
            if (r, f) in grams and whole[0, 0] > grams[r, f][0, 0]:
                fits.append((r, f, [float(v) for v in _solve(whole - grams[r, f], alpha)]))
    coef = spark.createDataFrame(fits, "repeat int, fold int, w array<double>")
    guess: Column = F.get("w", F.lit(0))
    for i in range(p - 1):
        guess = guess + F.get("w", F.lit(i + 1)) * x[i + 1]
    return (dealt.join(F.broadcast(coef), ["repeat", "fold"])
            .groupBy("repeat", "fold").agg(F.count(F.lit(1)).alias("n"), (-F.avg(F.abs(x[p] - guess))).alias("neg_mae")))
