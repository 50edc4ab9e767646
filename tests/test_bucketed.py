"""Positions stored by vehicle are paired without an exchange, hot vehicles apart."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.session import fresh_path
from flotilla.sources import bucketed as B
from flotilla.sources.fixture import positions

KEYS = ["event_id", "idVehiculo", "epochTime"]


def _brute(p):
    w = Window.partitionBy("idVehiculo").orderBy("epochTime", "event_id")
    return {r[0]: r[1] for r in p.select("event_id", F.lag("event_id").over(w)).collect()}


def _pairs(spark, path, **how):
    rows = B.previous_stored(spark, path, KEYS, **how).select("event_id", F.col("prev.event_id").alias("p")).collect()
    got = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows)
    return got


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark):
    return positions(spark, SF_SMALL).select(*KEYS, "latitud", "ingest_date")


def test_no_exchange(spark, table):
    path = fresh_path(spark, "by-vehicle")
    B.write_bucketed(table, path, buckets=5)
    df = B.previous_stored(spark, path, KEYS)
    plan = _plan(df)
    assert "Exchange" not in plan and "Bucketed: true" in plan and "latitud" not in plan
    assert _pairs(spark, path) == _brute(table)
    assert sorted(map(tuple, B.read_bucketed(spark, path).select(*KEYS).collect())) == sorted(map(tuple, table.select(*KEYS).collect()))
    # Only the range's folders are read.
    ranged = B.previous_stored(spark, path, KEYS, start="2024-01-05", end="2024-01-08")
    assert "Exchange" not in _plan(ranged) and "PartitionFilters: [isnotnull(ingest_date" in _plan(ranged)
    assert _pairs(spark, path, start="2024-01-05", end="2024-01-08") == _brute(table.where("ingest_date BETWEEN '2024-01-05' AND '2024-01-08'"))


def test_dates_added_and_repeated(spark, table):
    path = fresh_path(spark, "by-vehicle")
    early = F.col("ingest_date") < F.lit("2024-01-10").cast("date")
    for part in (~early, early, ~early):
        B.write_bucketed(table.where(part), path, buckets=3)
    assert _pairs(spark, path) == _brute(table)
    assert "Exchange" not in _plan(B.previous_stored(spark, path, KEYS))


def test_hot_vehicles_and_rows_without_one(spark, table):
    """One vehicle holds a third of the rows, and is hot only once the later dates are
    there; a fifth has none."""
    p = table.withColumn("idVehiculo", F.when(F.col("event_id") % 5 == 0, F.lit(None)).when(F.col("event_id") % 3 == 0, "HOT").otherwise(F.col("idVehiculo")))
    early = F.col("ingest_date") < F.lit("2024-01-06").cast("date")
    limit = p.where(early & F.col("idVehiculo").eqNullSafe(F.lit("HOT"))).count()
    path = fresh_path(spark, "by-vehicle")
    B.write_bucketed(p.where(early), path, buckets=4, hot_rows=limit)
    assert B._hot_vehicles(spark, path).count() == 0
    B.write_bucketed(p.where(~early), path, hot_rows=limit)
    assert "HOT" in [r[0] for r in B._hot_vehicles(spark, path).collect()]
    assert _pairs(spark, path, hot_rows=limit) == _brute(p)
    # What isn't hot still isn't shuffled: the bucketed scan feeds its window directly.
    assert "Bucketed: true" in _plan(B.previous_stored(spark, path, KEYS, hot_rows=limit))
    for part in (early, ~early):                       # repeated, now all of it goes apart
        B.write_bucketed(p.where(part), path, hot_rows=limit)
    assert _pairs(spark, path, hot_rows=limit) == _brute(p)
    cold = B._plain(spark, path, "cold", p.schema)
    assert cold.where("idVehiculo = 'HOT' OR idVehiculo IS NULL").count() == 0


def test_empty_table(spark, table):
    path = fresh_path(spark, "by-vehicle")
    B.write_bucketed(table.limit(0), path, buckets=2)
    assert _pairs(spark, path) == {}
    B.write_bucketed(table, path)
    assert _pairs(spark, path) == _brute(table)
