"""Workload D model queries: predictions, error tables, CV summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from flotilla.operators import cart
from flotilla.operators import evaluate as E
from flotilla.operators import features as FT
from flotilla.operators import models as M
from flotilla.operators.moments import cross_validate_linear
from flotilla.plans.catalog import register
from flotilla.plans.q_demand import KEYED_CTE
from flotilla.plans.sqltext import hash_bucket_sql, ols_ctes, positions_sql
from flotilla.session import cut_lineage
from flotilla.plans.studies import KEY, demand_study, features_from, study_input

_F3 = M.MODEL_FEATURES

MOTO_CTES = KEYED_CTE + """,
train AS (SELECT * FROM split WHERE is_train AND tipoVehiculo = 'moto'),
test AS (SELECT * FROM split WHERE NOT is_train AND tipoVehiculo = 'moto')"""


def _pred_cte(alpha: float) -> str:
    return (MOTO_CTES + ",\n" + ols_ctes("train", _F3, "numTrips", alpha) + """,
pred AS (SELECT row_key, "hour", clusterId, numAvailable, cast(numTrips AS DOUBLE) AS Real,
         b + w1 * "hour" + w2 * clusterId + w3 * numAvailable AS Prediction FROM test, coef)""")


_OUT = ["row_key", "hour", "clusterId", "numAvailable", "Real", "Prediction"]
_ERR_SQL = "Real - Prediction AS Err, abs(Real - Prediction) / numAvailable AS ErrPorcentage"


def _linear(spark, sf_dir, kind="linear"):
    return demand_study(features_from(spark, sf_dir), "moto", _F3, "numTrips", kind)


@register("linear_trips", positions_sql(
    "SELECT * FROM pred", _pred_cte(0.0), doubles=["Real", "Prediction"]))
def linear_trips(spark, sf_dir):
    """M5: least squares on the moto training rows, predictions for the test rows."""
    return _linear(spark, sf_dir).select(*_OUT)


@register("prediction_errors", positions_sql(
    f"SELECT row_key, Real, Prediction, {_ERR_SQL} FROM pred", _pred_cte(0.0),
    doubles=["Real", "Prediction", "Err", "ErrPorcentage"]))
def prediction_errors(spark, sf_dir):
    """Err and ErrPorcentage of the linear model."""
    return _linear(spark, sf_dir).select(KEY, "Real", "Prediction", "Err", "ErrPorcentage")


@register("prediction_errors_rounded", positions_sql(
    "SELECT row_key, Real, round_even(Prediction, 0) AS Prediction, "
    "Real - round_even(Prediction, 0) AS Err FROM pred", _pred_cte(0.0),
    doubles=["Real", "Prediction", "Err"]))
def prediction_errors_rounded(spark, sf_dir):
    """Predictions rounded half-to-even, then the error."""
    p = _linear(spark, sf_dir).withColumn("Prediction", E.round_half_even(F.col("Prediction")))
    return E.errors(p, available=None).select(KEY, "Real", "Prediction", "Err")


@register("error_by_real", positions_sql(
    "SELECT Real, avg(numAvailable) AS numAvailable, avg(Prediction) AS Prediction FROM pred GROUP BY Real",
    _pred_cte(0.0), doubles=["Real", "numAvailable", "Prediction"]))
def error_by_real(spark, sf_dir):
    """A5: mean availability and prediction per true value."""
    return E.mean_by(_linear(spark, sf_dir), "Real", ["numAvailable", "Prediction"])


_HIST_SQL = """, e AS (SELECT Real - Prediction AS v FROM pred),
r AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 5e-1 ELSE min(v) END AS lo0,
             CASE WHEN min(v) = max(v) THEN max(v) + 5e-1 ELSE max(v) END AS hi0 FROM e),
c AS (SELECT least(cast(floor((v - lo0) / (hi0 - lo0) * {bins}) AS BIGINT) + 1, {bins}) AS bin, count(*) AS n
      FROM e, r GROUP BY 1),
ids AS (SELECT range AS bin FROM range(1, {bins} + 1))"""


@register("error_histogram", positions_sql(
    "SELECT ids.bin AS bin, lo0 + (ids.bin - 1) * ((hi0 - lo0) / 4e2) AS lo, "
    "lo0 + ids.bin * ((hi0 - lo0) / 4e2) AS hi, coalesce(c.n, 0) AS n "
    "FROM ids CROSS JOIN r LEFT JOIN c ON ids.bin = c.bin",
    _pred_cte(0.0) + _HIST_SQL.format(bins=E.HIST_BINS_FINE), doubles=["lo", "hi"]))
def error_histogram(spark, sf_dir):
    """400-bin histogram of the linear model's errors."""
    return E.histogram(_linear(spark, sf_dir), "Err", E.HIST_BINS_FINE)


@register("ridge_trips", positions_sql(
    f"SELECT row_key, Real, Prediction, {_ERR_SQL} FROM pred", _pred_cte(M.RIDGE_ALPHA),
    doubles=["Real", "Prediction", "Err", "ErrPorcentage"]))
def ridge_trips(spark, sf_dir):
    """M6: ridge (alpha 0.5) -- predicting with the ridge model itself."""
    return _linear(spark, sf_dir, "ridge").select(KEY, "Real", "Prediction", "Err", "ErrPorcentage")


@register("error_histogram_default", positions_sql(
    "SELECT ids.bin AS bin, lo0 + (ids.bin - 1) * ((hi0 - lo0) / 1e1) AS lo, "
    "lo0 + ids.bin * ((hi0 - lo0) / 1e1) AS hi, coalesce(c.n, 0) AS n "
    "FROM ids CROSS JOIN r LEFT JOIN c ON ids.bin = c.bin",
    _pred_cte(0.0) + _HIST_SQL.format(bins=E.HIST_BINS), doubles=["lo", "hi"]))
def error_histogram_default(spark, sf_dir):
    """The default 10-bin histogram of the linear model's errors."""
    return E.histogram(_linear(spark, sf_dir), "Err")


@register("error_percent_histogram", positions_sql(
    "SELECT ids.bin AS bin, lo0 + (ids.bin - 1) * ((hi0 - lo0) / 4e2) AS lo, "
    "lo0 + ids.bin * ((hi0 - lo0) / 4e2) AS hi, coalesce(c.n, 0) AS n "
    "FROM ids CROSS JOIN r LEFT JOIN c ON ids.bin = c.bin",
    _pred_cte(0.0) + _HIST_SQL.format(bins=E.HIST_BINS_FINE).replace(
        "Real - Prediction AS v", "abs(Real - Prediction) / numAvailable AS v"), doubles=["lo", "hi"]))
def error_percent_histogram(spark, sf_dir):
    """400-bin histogram of the linear model's ErrPorcentage."""
    return E.histogram(_linear(spark, sf_dir), "ErrPorcentage", E.HIST_BINS_FINE)


@register("count_by_real", positions_sql(
    "SELECT Real, count(Prediction) AS Prediction, count(*) AS Err FROM pred GROUP BY Real",
    _pred_cte(0.0), doubles=["Real"]))
def count_by_real(spark, sf_dir):
    """A4 on a result: rows per true value."""
    return FT.count_by(_linear(spark, sf_dir).select("Real", "Prediction", "Err"), "Real")


@register("ridge_r2", positions_sql(
    "SELECT 1 - sum((Real - Prediction) * (Real - Prediction)) / (var_pop(Real) * count(*)) AS r2 FROM pred",
    _pred_cte(M.RIDGE_ALPHA), doubles=["r2"]))
def ridge_r2(spark, sf_dir):
    """M6: R^2 of the ridge model on the test rows, as one aggregate."""
    p = _linear(spark, sf_dir, "ridge")
    ss_res = F.sum((F.col("Real") - F.col("Prediction")) ** 2)
    ss_tot = F.var_pop("Real") * F.count(F.lit(1))
    return p.agg((F.lit(1.0) - ss_res / ss_tot).alias("r2"))


# Cross-validation of the linear model: every fold's fit in closed form.

_FOLD_SQL = hash_bucket_sql("concat(cast(r AS VARCHAR), '|', row_key)", E.CV_FOLDS)


def _cv_ctes(alpha: float) -> str:
    ols = ols_ctes("fitted GROUP BY r, f", _F3, "numTrips", alpha)
    ols = ols.replace("SELECT count(*) AS n", "SELECT r, f, count(*) AS n").replace("SELECT w1, w2, w3,", "SELECT r, f, w1, w2, w3,")
    return MOTO_CTES + f""",
foldsr AS (SELECT train.*, r, {_FOLD_SQL} AS fold FROM train, (SELECT unnest(range({E.CV_REPEATS})) AS r)),
fitted AS (SELECT foldsr.*, f FROM foldsr, (SELECT unnest(range({E.CV_FOLDS})) AS f) WHERE fold <> f),
{ols},
cv AS (SELECT foldsr.r AS repeat, fold, count(*) AS n, -avg(abs(numTrips - (b + w1 * "hour" + w2 * clusterId + w3 * numAvailable))) AS neg_mae
       FROM foldsr JOIN coef ON foldsr.r = coef.r AND fold = f GROUP BY ALL)"""


def _cv_linear(spark, sf_dir, alpha=0.0):
    data = cut_lineage(E.with_split(study_input(features_from(spark, sf_dir), "moto"), [KEY]).where(F.col("is_train")))
    return cross_validate_linear(data, _F3, "numTrips", [KEY], alpha=alpha)


@register("cv_mae_linear", positions_sql("SELECT * FROM cv", _cv_ctes(0.0), doubles=["neg_mae"]))
def cv_mae_linear(spark, sf_dir):
    """M8: 10 x 3 repeated K-fold of the linear model, all fits from one aggregate of moments."""
    return _cv_linear(spark, sf_dir)


_SUMMARY_SQL = "SELECT avg(neg_mae) AS mean_neg_mae, stddev_pop(neg_mae) AS std_neg_mae, count(*) AS n_scores FROM cv"


def _summary(scores):
    return scores.agg(F.avg("neg_mae").alias("mean_neg_mae"), F.stddev_pop("neg_mae").alias("std_neg_mae"), F.count(F.lit(1)).alias("n_scores"))


@register("cv_mae_linear_summary", positions_sql(_SUMMARY_SQL, _cv_ctes(0.0), doubles=["mean_neg_mae", "std_neg_mae"]))
def cv_mae_linear_summary(spark, sf_dir):
    """Mean and population std of the linear model's scores."""
    return _summary(_cv_linear(spark, sf_dir))


@register("cv_mae_ridge_summary", positions_sql(_SUMMARY_SQL, _cv_ctes(M.RIDGE_ALPHA), doubles=["mean_neg_mae", "std_neg_mae"]))
def cv_mae_ridge_summary(spark, sf_dir):
    """The same for the ridge model."""
    return _summary(_cv_linear(spark, sf_dir, M.RIDGE_ALPHA))


# What SQL can say of a tree: every candidate split of its root, and the weights of a bootstrap.

_SPLITS_SQL = """SELECT f, v, (v + next) / 2 AS threshold, left2 / n + right2 / (total - n) AS score FROM (
  SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS next, n, left2, right2, max(n) OVER (PARTITION BY f) AS total FROM (
    SELECT a.f, a.v, sum(l) AS n, sum(l * l) AS left2, sum((t - l) * (t - l)) AS right2 FROM (
      SELECT a.f, a.v, c.y, any_value(c.t) AS t, coalesce(sum(b.k), 0) AS l FROM (SELECT DISTINCT f, v FROM long) a
      JOIN (SELECT f, y, sum(k) AS t FROM long GROUP BY f, y) c ON a.f = c.f
      LEFT JOIN long b ON b.f = a.f AND b.v <= a.v AND b.y = c.y GROUP BY a.f, a.v, c.y) a GROUP BY a.f, a.v)) WHERE next IS NOT NULL"""
_LONG_CTE = MOTO_CTES + ",\nlong AS (" + " UNION ALL ".join(
    f'SELECT {i} AS f, cast("{c}" AS DOUBLE) AS v, cast(numTrips AS DOUBLE) AS y, count(*) AS k FROM train GROUP BY ALL' for i, c in enumerate(_F3)) + ")"


@register("tree_root_splits", positions_sql(_SPLITS_SQL, _LONG_CTE, doubles=["v", "threshold", "score"]))
def tree_root_splits(spark, sf_dir):
    """M2: every split the exact tree weighs at its root, with its Gini score (moto training rows)."""
    data = E.with_split(study_input(features_from(spark, sf_dir), "moto"), [KEY]).where(F.col("is_train"))
    rows = data.select(F.lit(0).alias("tree"), F.lit("").alias("node"), *[F.col(c).cast("double").alias(c) for c in _F3],
                       F.col("numTrips").cast("double").alias("y"), F.lit(1).alias("w"))
    return cart.candidates(rows, _F3, True).select("f", "v", "threshold", "score")


_U = "(('0x' || substr(md5(concat(cast(tree AS VARCHAR), '|', row_key)), 1, 8))::BIGINT)"


@register("bootstrap_weights", positions_sql(
    "SELECT row_key, tree, " + " + ".join(f"cast({_U} >= {t} AS BIGINT)" for t in cart._POISSON)
    + f" AS weight FROM train, (SELECT unnest(range({M.BAGGING_TREES})) AS tree)", MOTO_CTES, ints=["weight"]))
def bootstrap_weights(spark, sf_dir):
    """M7: how often each training row is in each tree's sample."""
    data = E.with_split(study_input(features_from(spark, sf_dir), "moto"), [KEY]).where(F.col("is_train"))
    trees = data.select(KEY, F.explode(F.sequence(F.lit(0), F.lit(M.BAGGING_TREES - 1))).alias("tree"))
    return trees.select(KEY, "tree", cart.bootstrap_weight(E.row_key([KEY]), F.col("tree")).alias("weight"))


# Model fits without a closed form: rows-only checks, held against plain Python in the tests.

@register("exact_tree_trips")
def exact_tree_trips(spark, sf_dir):
    """M2 / M4: the exact tree on all types; prediction = P(numTrips = 1) rounded."""
    return demand_study(features_from(spark, sf_dir), None, _F3, "numTrips", "exact_tree")


@register("exact_tree_trips_moto")
def exact_tree_trips_moto(spark, sf_dir):
    """M2: the exact tree on the moto rows, class predictions."""
    return demand_study(features_from(spark, sf_dir), "moto", _F3, "numTrips", "exact_tree_class")


@register("exact_tree_yes_no")
def exact_tree_yes_no(spark, sf_dir):
    """M3: does a trip happen -- the exact binary tree, P(yes) rounded."""
    return demand_study(features_from(spark, sf_dir), None, _F3, "tripYesNo", "exact_tree")


@register("exact_bagging_trips")
def exact_bagging_trips(spark, sf_dir):
    """M7: ten exact trees on bootstrap weights, trip counts of the moto rows."""
    return demand_study(features_from(spark, sf_dir), "moto", _F3, "numTrips", "exact_bagging")


@register("exact_bagging_yes_no_no_avail")
def exact_bagging_yes_no_no_avail(spark, sf_dir):
    """M7: the same for the yes/no label without numAvailable as a feature."""
    return demand_study(features_from(spark, sf_dir), None, M.FEATURES_NO_AVAILABILITY, "tripYesNo", "exact_bagging", with_pct=False)


@register("tree_trips")
def tree_trips(spark, sf_dir):
    """M2 / M4: decision tree on all types; prediction = P(numTrips = 1) rounded."""
    return demand_study(features_from(spark, sf_dir), None, _F3, "numTrips", "tree")


@register("tree_trips_moto")
def tree_trips_moto(spark, sf_dir):
    """M2: decision tree on the moto rows, class predictions."""
    return demand_study(features_from(spark, sf_dir), "moto", _F3, "numTrips", "tree_class")


@register("tree_yes_no")
def tree_yes_no(spark, sf_dir):
    """M3: does a trip happen -- binary tree, P(yes) rounded."""
    return demand_study(features_from(spark, sf_dir), None, _F3, "tripYesNo", "tree")


@register("bagging_trips")
def bagging_trips(spark, sf_dir):
    """M7: 10 bootstrap trees on the moto rows, trip counts."""
    return demand_study(features_from(spark, sf_dir), "moto", _F3, "numTrips", "bagging")


@register("bagging_yes_no")
def bagging_yes_no(spark, sf_dir):
    """M7: bagged trees for the yes/no label, all types."""
    return demand_study(features_from(spark, sf_dir), None, _F3, "tripYesNo", "bagging")


@register("bagging_yes_no_no_avail")
def bagging_yes_no_no_avail(spark, sf_dir):
    """M7: the same without numAvailable as a feature (no ErrPorcentage)."""
    return demand_study(features_from(spark, sf_dir), None, M.FEATURES_NO_AVAILABILITY, "tripYesNo",
                        "bagging", with_pct=False)


# What SQL can check of these fits: the rows predicted, their true values and
# the errors' arithmetic.

_FITS = {
    "tree_trips": (tree_trips, "", "numTrips", True),
    "tree_trips_moto": (tree_trips_moto, " AND tipoVehiculo = 'moto'", "numTrips", True),
    "tree_yes_no": (tree_yes_no, "", "CASE WHEN numTrips > 0 THEN 1 ELSE 0 END", True),
    "bagging_trips": (bagging_trips, " AND tipoVehiculo = 'moto'", "numTrips", True),
    "bagging_yes_no": (bagging_yes_no, "", "CASE WHEN numTrips > 0 THEN 1 ELSE 0 END", True),
    "bagging_yes_no_no_avail": (bagging_yes_no_no_avail, "", "CASE WHEN numTrips > 0 THEN 1 ELSE 0 END", False),
}


def _checked(fit, percent: bool):
    def run(spark, sf_dir):
        p = fit(spark, sf_dir)
        err = F.abs(F.col("Err") - (F.col("Real") - F.col("Prediction"))) < 1e-9
        pct = F.abs(F.col("ErrPorcentage") * F.col("numAvailable") - F.abs("Err")) < 1e-6 if percent else F.lit(True)
        return p.select(KEY, "Real", err.alias("err_ok"), pct.alias("pct_ok"))
    run.__doc__ = "Rows, true values and error arithmetic of the fit."
    return run


for _name, (_fit, _where, _label, _percent) in _FITS.items():
    register(f"{_name}_check", positions_sql(
        f"SELECT row_key, cast({_label} AS DOUBLE) AS Real, TRUE AS err_ok, TRUE AS pct_ok "
        f"FROM split WHERE NOT is_train{_where}", KEYED_CTE, doubles=["Real"]))(_checked(_fit, _percent))


@register("bagging_trips_rounded")
def bagging_trips_rounded(spark, sf_dir):
    """Bagged predictions rounded half-to-even, with Err and ErrPorcentage."""
    p = bagging_trips(spark, sf_dir).withColumn("Prediction", E.round_half_even(F.col("Prediction")))
    return E.errors(p).select(KEY, "Real", "Prediction", "Err", "ErrPorcentage")


@register("bagging_yes_no_rounded")
def bagging_yes_no_rounded(spark, sf_dir):
    """The same for the yes/no label."""
    p = bagging_yes_no(spark, sf_dir).withColumn("Prediction", E.round_half_even(F.col("Prediction")))
    return E.errors(p).select(KEY, "Real", "Prediction", "Err", "ErrPorcentage")


def _tables_of(fit, percent: bool):
    """Error tables of a fit in one long form: 400-bin histograms of Err and
    ErrPorcentage, and mean availability and prediction by true value."""
    def run(spark, sf_dir):
        p = cut_lineage(fit(spark, sf_dir), "predictions")
        parts = [E.histogram(p, c, E.HIST_BINS_FINE).select(F.lit(c).alias("name"), F.col("lo").alias("at"), F.col("n").cast("double").alias("value"))
                 for c in ["Err", *["ErrPorcentage"] * percent]]
        mean = E.mean_by(p, "Real", ["numAvailable", "Prediction"])
        parts += [mean.select(F.lit(f"mean {c}").alias("name"), F.col("Real").alias("at"), F.col(c).alias("value")) for c in ("numAvailable", "Prediction")]
        out = parts[0]
        for x in parts[1:]:
            out = out.unionByName(x)
        return out
    run.__doc__ = "A5 / A9: the error tables of the fit."
    return run


for _name, (_fit, _where, _label, _percent) in _FITS.items():
    register(f"{_name}_error_tables")(_tables_of(_fit, _percent))


def _cv(spark, sf_dir, vehicle_type, features, label):
    data = cut_lineage(E.with_split(study_input(features_from(spark, sf_dir), vehicle_type), [KEY])
                       .where(F.col("is_train")))
    scores = M.cross_validate(data, features, label, [KEY], kind="bagging")
    s = spark.createDataFrame(scores, "repeat int, fold int, neg_mae double")
    return s.agg(F.avg("neg_mae").alias("mean_neg_mae"), F.stddev_pop("neg_mae").alias("std_neg_mae"),
                 F.count(F.lit(1)).alias("n_scores"))


@register("cv_mae_summary")
def cv_mae_summary(spark, sf_dir):
    """10 x 3 repeated K-fold of the bagged trees on the moto
    training rows; mean and population std of the negative MAE."""
    return _cv(spark, sf_dir, "moto", _F3, "numTrips")


@register("cv_mae_summary_yes_no")
def cv_mae_summary_yes_no(spark, sf_dir):
    """M8: the same for the yes/no label on all types."""
    return _cv(spark, sf_dir, None, _F3, "tripYesNo")


@register("cv_mae_summary_yes_no_no_avail")
def cv_mae_summary_yes_no_no_avail(spark, sf_dir):
    """M8: the same without numAvailable."""
    return _cv(spark, sf_dir, None, M.FEATURES_NO_AVAILABILITY, "tripYesNo")
