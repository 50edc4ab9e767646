"""Demand models with ``pyspark.ml`` (workload D).

Trees, linear / ridge regression and bagged trees fit on a distributed
DataFrame; predictions come back as columns of the test rows
(``model.transform`` keeps every input column, so no index alignment is
needed). Ridge matches the closed form ``(X'X/n + alpha/n I) w = X'y/n`` on
centred data: Spark's normal-equation solver scales the penalty by the
label's standard deviation, so regParam = alpha * stddev_pop(y) / n.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flotilla.operators.evaluate import CV_FOLDS, CV_REPEATS, round_half_even, with_folds

# Model features of the study and the ridge penalty.
MODEL_FEATURES = ["hour", "clusterId", "numAvailable"]
FEATURES_NO_AVAILABILITY = ["hour", "clusterId"]
RIDGE_ALPHA = 0.5
# Spark's deepest tree (sklearn's trees are unbounded; 31 is rejected).
MAX_DEPTH = 30
# Fewest bins of a tree; see :func:`bins_of`.
MIN_BINS = 32
BAGGING_TREES = 10


def _prepared(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Features as a vector. A NULL feature fails the study: rows are never
    dropped in silence (fill or filter them before)."""
    va = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error")
    return va.transform(df).withColumn("_label", F.col(label).cast("double"))


def bins_of(train: DataFrame, features: Sequence[str]) -> int:
    """The largest number of distinct values of a feature, counted. With as many
    bins every value may be a split candidate, but Spark takes the candidates of a
    continuous feature from a sample (max(bins squared, 10,000) rows), so on a larger
    table rare values can be missing. :mod:`flotilla.operators.cart` has no such limit."""
    n = train.agg(*[F.countDistinct(c).alias(c) for c in features]).first()
    return max(MIN_BINS, *[int(x) for x in n])


def classes_of(train: DataFrame) -> list[float]:
    """The distinct labels, ascending: one per trip count that occurs."""
    return [r[0] for r in train.select("_label").distinct().orderBy("_label").collect()]


def indexed(train: DataFrame, classes: Sequence[float]) -> DataFrame:
    """Labels as places in ``classes``, with their number in the column's
    metadata: Spark takes a bare label for a class number and stops at 100."""
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("_label")) - 1
    meta = {"ml_attr": {"type": "nominal", "name": "_class", "vals": [str(c) for c in classes]}}
    return train.withColumn("_class", place.cast("double").alias("_class", metadata=meta))


def make_estimator(kind: str, train: DataFrame | None = None, seed: int = 1, alpha: float = RIDGE_ALPHA,
                   max_bins: int = MIN_BINS):
    """Trees stop at Spark's depth of 30 (:mod:`flotilla.operators.cart` doesn't)."""
    if kind in ("tree", "tree_class"):
        return DecisionTreeClassifier(featuresCol="_features", labelCol="_class", maxDepth=MAX_DEPTH,
                                      maxBins=max_bins, impurity="gini", seed=seed,
                                      predictionCol="_pred", probabilityCol="_prob",
                                      rawPredictionCol="_raw")
    if kind == "linear":
        return LinearRegression(featuresCol="_features", labelCol="_label", regParam=0.0,
                                elasticNetParam=0.0, solver="normal", predictionCol="_pred")
    if kind == "ridge":
        stats = train.agg(F.stddev_pop("_label").alias("s"), F.count(F.lit(1)).alias("n")).first()
        reg = alpha * float(stats["s"] or 0.0) / max(int(stats["n"]), 1)
        return LinearRegression(featuresCol="_features", labelCol="_label", regParam=reg,
                                elasticNetParam=0.0, standardization=False, solver="normal",
                                predictionCol="_pred")
    if kind == "bagging":
        return RandomForestRegressor(featuresCol="_features", labelCol="_label", numTrees=BAGGING_TREES,
                                     featureSubsetStrategy="all", bootstrap=True, subsamplingRate=1.0,
                                     maxDepth=MAX_DEPTH, maxBins=max_bins, seed=seed,
                                     predictionCol="_pred")
    raise ValueError(f"unknown model {kind!r}")


def fit_predict(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                kind: str, seed: int = 1, alpha: float = RIDGE_ALPHA,
                max_bins: int | None = None) -> tuple[object, DataFrame]:
    """Fit on ``train``; return (model, test rows + Real + Prediction). ``max_bins``
    of the trees is derived from the data unless given.

    kind='tree': the reference's prediction is P(class 1) rounded half-to-even
    (``predict_proba(X)[:, 1].round(0)``); 'tree_class' gives the class.
    """
    tr = _prepared(train, features, label)
    te = _prepared(test, features, label)
    bins = max_bins or (bins_of(train, features) if kind in ("tree", "tree_class", "bagging") else MIN_BINS)
    classes = classes_of(tr) if kind in ("tree", "tree_class") else []
    model = make_estimator(kind, tr, seed, alpha, bins).fit(indexed(tr, classes) if classes else tr)
    out = model.transform(te)
    if kind == "tree":
        # The probability of label 1, wherever it lies among the classes.
        one = F.get(vector_to_array("_prob"), classes.index(1.0)) if 1.0 in classes else F.lit(0.0)
        pred = round_half_even(one)
    elif kind == "tree_class":
        pred = F.get(F.array(*[F.lit(c) for c in classes]), F.col("_pred").cast("int"))
    else:
        pred = F.col("_pred")
    res = out.withColumn("Real", F.col("_label")).withColumn("Prediction", pred.cast("double"))
    return model, res.drop("_features", "_label", "_raw", "_prob", "_pred")


def cross_validate(df: DataFrame, features: Sequence[str], label: str, key_cols: Sequence[str],
                   kind: str = "bagging", folds: int = CV_FOLDS, repeats: int = CV_REPEATS,
                   seed: int = 1, parallel: int = 4) -> list[tuple[int, int, float]]:
    """Repeated K-fold CV scored by negative MAE: [(repeat, fold, score)].

    Fold ids are hashes of (repeat, row key), so the folds are reproducible.
    Each fit is a distributed job; up to ``parallel`` fits run concurrently.
    """
    base = _prepared(df, features, label)
    bins = bins_of(df, features)
    ev = RegressionEvaluator(labelCol="_label", predictionCol="_pred", metricName="mae")

    def one(rf):
        r, f = rf
        d = with_folds(base, key_cols, folds, repeat=r, out="_fold")
        model = make_estimator(kind, d.where(F.col("_fold") != f), seed + r, RIDGE_ALPHA, bins) \
            .fit(d.where(F.col("_fold") != f))
        return r, f, -ev.evaluate(model.transform(d.where(F.col("_fold") == f)))

    jobs = [(r, f) for r in range(repeats) for f in range(folds)]
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(one, jobs))
