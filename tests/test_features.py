"""Cleaning, group tables, rounding and histogram edge rows."""

import numpy as np
import pytest

from flotilla.operators import evaluate as E
from flotilla.operators import features as FT

COLS = ("servicio string, tipoVehiculo string, year int, month int, day int, weekday string, hour int, "
        "clusterId long, clusterLatitude double, clusterLongitude double, numAvailable long, numTrips long")


def _features(spark):
    rows = [
        ("s", "moto", 2024, 1, 4, "Thursday", 8, 1, 40.41, -3.7, 0, 3),       # no availability: dropped
        ("s", "moto", 2024, 1, 4, "Thursday", 9, 1, 40.41, -3.7, None, 1),    # NULL availability: dropped
        ("s", "moto", 2024, 1, 4, "Thursday", 10, 1, 40.41, -3.7, 2, None),   # NULL trips -> 0
        ("s", "coche", 2024, 1, 4, "Thursday", 11, 2, 40.42, -3.7, 3, 2),
        ("s", "coche", 2024, 1, 5, "Friday", 11, 2, 40.42, -3.7, 3, 2),      # not Thursday
        (None, "coche", 2024, 1, 4, "Thursday", 12, 2, 40.42, -3.7, 1, None),
    ]
    return spark.createDataFrame(rows, COLS)


def test_clean_demand(spark):
    clean = FT.clean_demand(_features(spark)).collect()
    assert sorted((r["hour"], r["numTrips"]) for r in clean) == [(10, 0), (11, 2), (12, 0)]
    assert set(clean[0].asDict()) == {"servicio", "tipoVehiculo", "weekday", "hour", "clusterId",
                                      "numAvailable", "numTrips"}


def test_count_by_drops_null_keys(spark):
    got = {r["numTrips"]: r.asDict() for r in FT.count_by(_features(spark), "numTrips").collect()}
    assert set(got) == {3, 1, 2}
    assert got[1]["numAvailable"] == 0          # non-NULL count, like pandas
    assert got[2]["servicio"] == 2


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    got = [r[0] for r in df.select(E.round_half_even(df.x)).collect()]
    assert got == [0.0, 2.0, 2.0, -0.0]


@pytest.mark.parametrize("values,bins", [([1.0, 2.0, 3.0, 10.0], 3), ([5.0, 5.0], 2),
                                         ([float(v) for v in np.linspace(-3, 7, 101)], 10), ([0.1, 0.2, 0.9], 400)])
def test_histogram_like_numpy(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    got = E.histogram(df, "x", bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins)
    assert [r["n"] for r in got] == list(counts)
    assert sum(r["n"] for r in got) == len(values)
    assert [r["lo"] for r in got] == pytest.approx(list(edges[:-1]))
    assert got[-1]["hi"] == pytest.approx(edges[-1])


def test_weekday_number(spark):
    df = spark.createDataFrame([("Monday",), ("Thursday",), ("Sunday",), ("nope",)], "d string")
    assert [r[0] for r in df.select(FT.weekday_number(df.d)).collect()] == [1, 4, 7, None]


def test_split_is_deterministic(spark):
    df = spark.range(0, 2000).selectExpr("cast(id as string) as k")
    a = E.with_split(df, ["k"]).where("is_train").count()
    b = E.with_split(df.repartition(7), ["k"]).where("is_train").count()
    assert a == b and 1350 < a < 1650


def test_histogram_skips_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    got = E.histogram(df, "x", 2).orderBy("bin").collect()
    assert [r["n"] for r in got] == [1, 1] and got[-1]["hi"] == 2.0


def test_feature_view_approx_availability(spark):
    from conftest import SF_SMALL
    from flotilla.operators.trips import extract_trips
    from flotilla.sources.fixture import positions
    p = positions(spark, SF_SMALL)
    t = extract_trips(p, "vehicle", compat=True)
    keys = FT.FEATURE_KEYS
    exact = {tuple(r[k] for k in keys): r["numAvailable"] for r in FT.cluster_hour_features(p, t).collect()}
    approx = {tuple(r[k] for k in keys): r["numAvailable"]
              for r in FT.cluster_hour_features(p, t, approx_rsd=0.01).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(exact[k] - approx[k]) <= max(1, 0.05 * exact[k]) for k in exact)
