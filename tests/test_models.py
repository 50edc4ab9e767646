"""Regression fits against numpy's normal equations (FIXTURES.md part 3)."""

import numpy as np
import pytest

from conftest import SF_MID
from flotilla.operators import models as M
from flotilla.plans.studies import features_from, study_input

OLS = [-0.001964007, 0.066115269, 0.674160992]
RIDGE = [-0.001963319, 0.066008693, 0.671988181]


@pytest.fixture(scope="module")
def thursday(spark):
    return study_input(features_from(spark, SF_MID)).cache()


def test_thursday_rows(thursday):
    assert thursday.count() == 1194


@pytest.mark.parametrize("kind,want,alpha", [("linear", OLS, 0.0), ("ridge", RIDGE, 0.5)])
def test_linear_and_ridge_coefficients(thursday, kind, want, alpha):
    tr = M._prepared(thursday, M.MODEL_FEATURES, "numTrips")
    model = M.make_estimator(kind, tr, alpha=alpha).fit(tr)
    assert list(model.coefficients) == pytest.approx(want, abs=2e-9)
    pdf = thursday.select(*M.MODEL_FEATURES, "numTrips").toPandas().astype(float)
    x = pdf[M.MODEL_FEATURES].to_numpy()
    y = pdf["numTrips"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert list(model.coefficients) == pytest.approx(list(w), abs=1e-9)


def test_tree_and_bagging_run(thursday):
    data = thursday.where("tipoVehiculo = 'moto'")
    for kind in ("tree", "tree_class", "bagging"):
        _, pred = M.fit_predict(data, data, M.MODEL_FEATURES, "numTrips", kind)
        assert pred.where("Prediction IS NULL").count() == 0


def test_more_than_a_hundred_classes(spark):
    df = spark.range(600).selectExpr("id % 150 AS numTrips", "id % 150 AS hour", "id % 7 AS clusterId", "id % 5 AS numAvailable")
    _, pred = M.fit_predict(df, df, M.MODEL_FEATURES, "numTrips", "tree_class")
    assert pred.where("Prediction <> Real").count() == 0
    _, one = M.fit_predict(df.where("numTrips <> 0"), df, M.MODEL_FEATURES, "numTrips", "tree")
    got = {r.Real: r.Prediction for r in one.collect()}
    assert got[1.0] == 1.0 and got[2.0] == 0.0 and got[149.0] == 0.0


def test_null_feature_fails(spark):
    df = spark.createDataFrame([(1, 2, 3, 1), (2, None, 3, 0)], "hour int, clusterId int, numAvailable int, numTrips int")
    with pytest.raises(Exception):
        M.fit_predict(df, df, M.MODEL_FEATURES, "numTrips", "linear")[1].collect()
