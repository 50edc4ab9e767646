"""Distance edge rows (FIXTURES.md part 4)."""

import pytest
from pyspark.sql import functions as F

from flotilla.functions.geo import haversine_km, pair_distance_km

# (start lat, lon, end lat, lon, strict km or None, compat km or None)
CASES = [
    (40.00, -3.0, 40.01, -3.0, 1.112263, 1.112263),      # moved 0.01 deg
    (40.0, -3.0, 40.0, -3.0, 0.0, 0.0),                   # unchanged
    (40.0, -3.0, 40.0005, -3.0, 0.055613, 0.055613),      # below 0.1 km
    (None, -3.0, 40.0, -3.0, None, None),                 # start missing
    (40.0, 0.0, 40.0, -3.0, None, None),                  # start lon = 0
    (40.0, -3.0, None, None, None, 4459.448852),          # end missing: to (0, 0) in compat
    (40.0, -3.0, -40.0, 177.0, 20020.727265, 20020.727265),  # antipodal, not NaN
]


def test_pair_distances(spark):
    df = spark.createDataFrame(CASES, "a double, b double, c double, d double, s double, k double")
    out = df.select(
        F.round(pair_distance_km("a", "b", "c", "d", compat=False), 6).alias("strict"),
        F.round(pair_distance_km("a", "b", "c", "d", compat=True), 6).alias("compat"),
        "s", "k").collect()
    for r in out:
        assert r["strict"] == (None if r["s"] is None else pytest.approx(r["s"], abs=1e-6))
        assert r["compat"] == (None if r["k"] is None else pytest.approx(r["k"], abs=1e-6))


def test_haversine_symmetric_and_zero(spark):
    df = spark.createDataFrame([(40.4, -3.7, 41.0, 2.1)], "a double, b double, c double, d double")
    r = df.select(haversine_km("a", "b", "c", "d").alias("x"), haversine_km("c", "d", "a", "b").alias("y"),
                  haversine_km("a", "b", "a", "b").alias("z")).first()
    assert r["x"] == pytest.approx(r["y"], rel=1e-12)
    assert r["z"] == 0.0
