"""Pairing and numbering: every strategy equals a single-partition window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.operators.ordered import lag_in_global_order, offset_in_global_order
from flotilla.operators.pairs import attach_previous, row_numbers
from flotilla.operators.trips import extract_trips
from flotilla.sources.fixture import positions

KEYS = ["event_id", "idVehiculo", "epochTime"]


def _brute_prev(p, scope):
    spec = Window.orderBy(F.col("idVehiculo").asc_nulls_first(), "epochTime", "event_id")
    if scope == "vehicle":
        spec = Window.partitionBy("idVehiculo").orderBy("epochTime", "event_id")
    return {r[0]: r[1] for r in p.select("event_id", F.lag("event_id").over(spec)).collect()}


@pytest.mark.parametrize("scope", ["vehicle", "global"])
@pytest.mark.parametrize("hot_rows", [None, 0, 200_000, 50])
def test_attach_previous_matches_window(spark, scope, hot_rows):
    p = positions(spark, SF_SMALL).select(*KEYS)
    got = attach_previous(p, scope=scope, hot_rows=hot_rows, n_ranges=3)
    got = {r[0]: r[1] for r in got.select("event_id", F.col("prev.event_id")).collect()}
    assert got == _brute_prev(p, scope)


@pytest.mark.parametrize("scope", ["vehicle", "global"])
@pytest.mark.parametrize("hot_rows", [None, 0, 200_000])
def test_row_numbers_match_window(spark, scope, hot_rows):
    p = positions(spark, SF_SMALL).select(*KEYS)
    spec = Window.orderBy(F.col("idVehiculo").asc_nulls_first(), "epochTime", "event_id")
    if scope == "vehicle":
        spec = Window.partitionBy("idVehiculo").orderBy("epochTime", "event_id")
    want = {r[0]: r[1] for r in p.select("event_id", F.row_number().over(spec)).collect()}
    got = row_numbers(p, scope=scope, hot_rows=hot_rows, n_ranges=5)
    assert {r[0]: r[1] for r in got.select("event_id", "tempField").collect()} == want


@pytest.mark.parametrize("n", [1, 2, 7, 50])
def test_global_helpers(spark, n):
    df = spark.range(0, 300).select((F.col("id") % 17).alias("k"), F.col("id").alias("v"),
                                    F.lit(2).alias("w"))
    got = lag_in_global_order(df, ["k", "v"], "v", "pv", n).collect()
    spec = Window.orderBy("k", "v")
    want = df.select("v", F.lag("v").over(spec).alias("pv"),
                     F.coalesce(F.sum("w").over(spec.rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("off")).collect()
    assert {r["v"]: r["pv"] for r in got} == {r["v"]: r["pv"] for r in want}
    off = offset_in_global_order(df, ["k", "v"], "w", "off", n).collect()
    assert {r["v"]: r["off"] for r in off} == {r["v"]: r["off"] for r in want}


def test_trip_control_counts(spark):
    p = positions(spark, SF_SMALL)
    assert extract_trips(p, "vehicle", compat=True).count() == 742
    assert extract_trips(p, "vehicle", compat=False).count() == 702
    assert extract_trips(p, "global", compat=True).count() == 753


def test_first_row_of_vehicle(spark):
    rows = [(1, "A", 100, 40.0, -3.0), (2, "A", 200, 40.01, -3.0), (3, "B", 50, 40.02, -3.0)]
    df = spark.createDataFrame(rows, "event_id long, idVehiculo string, epochTime long, latitud double, "
                                     "longitud double")
    per_vehicle = {r[0]: r[1] for r in attach_previous(df, scope="vehicle")
                   .select("event_id", "prev.event_id").collect()}
    assert per_vehicle == {1: None, 2: 1, 3: None}
    glob = {r[0]: r[1] for r in attach_previous(df, scope="global")
            .select("event_id", "prev.event_id").collect()}
    assert glob == {1: None, 2: 1, 3: 2}   # B's first row pairs with A's last


def test_flood_is_split_into_bounded_groups(spark):
    """A vehicle with most rows, most of them at one timestamp, is cut by the whole
    order, and the others stay whole."""
    from flotilla.operators.pairs import _bucketed
    rows = [(i, "A", 100) for i in range(500)] + [(500 + i, "A", 100 + i) for i in range(10)] \
        + [(600 + i, "B", 7 * i) for i in range(5)]
    df = spark.createDataFrame(rows, "event_id long, idVehiculo string, epochTime long")
    base, split = _bucketed(df, "idVehiculo", df.columns, 50, ["epochTime", "event_id"])
    assert split
    sizes = base.groupBy("_ent", "_b").count().collect()
    assert max(r["count"] for r in sizes if r["_ent"] == "A") <= 150
    assert [(r["_b"], r["count"]) for r in sizes if r["_ent"] == "B"] == [(None, 5)]
    got = {r[0]: r[1] for r in attach_previous(df, hot_rows=50).select("event_id", "prev.event_id").collect()}
    assert got[1] == 0 and got[500] == 499 and got[600] is None


def test_flood_without_an_integer_tie_breaker(spark):
    """No row id: floods are cut by realTime and uoid, text columns."""
    rows = [("A", 100, f"r{i // 10:03d}", f"u{i:04d}") for i in range(300)]
    df = spark.createDataFrame(rows, "idVehiculo string, epochTime long, realTime string, uoid string")
    for scope in ("vehicle", "global"):
        got = {r[0]: r[1] for r in attach_previous(df, hot_rows=20, scope=scope).select("uoid", "prev.uoid").collect()}
        assert got == {f"u{i:04d}": (f"u{i - 1:04d}" if i else None) for i in range(300)}


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_global_order_does_not_depend_on_exchange_reuse(spark, reuse):
    df = spark.range(0, 400_000, numPartitions=8).select(F.xxhash64("id").alias("k"), F.lit(1).alias("w"))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        off = offset_in_global_order(df, ["k"], "w", "off", 40).agg(F.countDistinct("off"), F.min("off"), F.max("off")).first()
        assert tuple(off) == (400_000, 0, 399_999)
        lag = lag_in_global_order(df, ["k"], "k", "p", 40)
        assert lag.agg(F.countDistinct("p"), F.count(F.when(F.col("p") >= F.col("k"), 1))).first()[:] == (399_999, 0)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
