"""The feature view by increments: what each ingestion date adds to it, stored in
a form that merges.

A run over some dates reads only their positions and the trips that end in them.
Per (date, feature key) it stores what is needed to count again later:

* the distinct vehicles, exactly, as bitmaps over dense vehicle numbers (32,768
  a bitmap; ``bitmap_or_agg`` merges those of one hour seen on several dates), or
  approximately as a sketch (``hll_union_agg``);
* the number of trips that began there.

The numbers come from a table of vehicles that only grows: a run numbers the
vehicles it is the first to see, after the ones known. A run replaces its dates'
entries, so it can be repeated. :func:`read_view` merges the entries; its work
follows the feature keys, not the positions.

    <base>/vehicles/from=N   numbers N, N + 1, ... (complete once it has _SUCCESS)
    <base>/parts/part=DATE   entries of a date

Positions without a vehicle add their key and nothing to its count; a date whose
positions are all gone keeps its entries until :func:`drop_dates`. One writer at a time.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flotilla.operators.features import FEATURE_COLUMNS, FEATURE_KEYS, keyed
from flotilla.operators.ordered import offset_in_global_order
from flotilla.session import cut_lineage
from flotilla.sources import files

PART = "part"
#: lg2 of the sketch's buckets: a relative standard deviation of about 1.6 %.
LG_BUCKETS = 12


def _numbers(spark: SparkSession, base: str) -> DataFrame | None:
    """(idVehiculo, number) of the vehicles known so far."""
    folder = os.path.join(base, "vehicles")
    paths = [os.path.join(folder, name) for name in files.complete(spark, folder)]
    return spark.read.schema("idVehiculo string, number long").parquet(*paths) if paths else None


def number_vehicles(vehicles: DataFrame, base: str) -> DataFrame:
    """Numbers of all vehicles, those of ``vehicles`` (one column, distinct) included.
    A run that broke off left a table that isn't complete: it is written anew."""
    spark = vehicles.sparkSession
    known, new = _numbers(spark, base), vehicles.where(F.col("idVehiculo").isNotNull())
    first = 0
    if known is not None:
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        new = new.join(known, "idVehiculo", "left_anti")
    new = cut_lineage(new, "new-vehicles")
    if known is None or not new.isEmpty():
        placed = offset_in_global_order(new.withColumn("_one", F.lit(1).cast("long")), ["idVehiculo"], "_one", "_place")
        path = os.path.join(base, "vehicles", f"from={first:012d}")
        placed.select("idVehiculo", (F.col("_place") + F.lit(first)).alias("number")).write.mode("overwrite").parquet(path)
    return _numbers(spark, base)


def _vehicles_of(seen: DataFrame, base: str) -> DataFrame:
    """Bitmaps of the vehicles per (part, key). ``seen`` has each vehicle once per key,
    so a vehicle with most of the positions has few rows here."""
    seen = cut_lineage(seen, "seen-vehicles")  # for the numbers and the bitmaps
    numbers = number_vehicles(seen.select("idVehiculo").distinct(), base)
    placed = seen.join(numbers, "idVehiculo", "left")
    return (placed.groupBy(PART, *FEATURE_KEYS, F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("vehicles")))


def write_increment(positions: DataFrame, trips: DataFrame, base: str, part_of_position: str = "ingest_date",
                    part_of_trip: str = "trip_date", approximate: bool = False) -> None:
    """Store what these positions and trips add, in place of the entries of their
    dates. A date comes whole: all its positions and all trips that end in it in one run."""
    p = keyed(positions, "timestamp", "clusterId", "clusterLatitude", "clusterLongitude",
              [F.col("idVehiculo"), F.col(part_of_position).cast("string").alias(PART)])
    t = keyed(trips, "timestamp_start", "clusterId_start", "clusterLatitude_start", "clusterLongitude_start",
              [F.col(part_of_trip).cast("string").alias(PART)])
    if approximate:
        seen = p.groupBy(PART, *FEATURE_KEYS).agg(F.hll_sketch_agg("idVehiculo", LG_BUCKETS).alias("vehicles"))
        seen = seen.withColumn("bucket", F.lit(None).cast("long"))
    else:
        seen = _vehicles_of(p.distinct(), base)
    moved = t.groupBy(PART, *FEATURE_KEYS).agg(F.count(F.lit(1)).alias("trips"))
    both = seen.unionByName(moved, allowMissingColumns=True)
    (both.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PART).parquet(os.path.join(base, "parts")))


def drop_dates(spark: SparkSession, base: str, dates: Sequence[str]) -> None:
    """Take dates out of the view."""
    for d in dates:
        files.delete(spark, os.path.join(base, "parts", f"{PART}={d}"))


def read_view(spark: SparkSession, base: str, approximate: bool = False) -> DataFrame:
    """The feature view over all stored dates: one row per key, as
    :func:`flotilla.operators.features.cluster_hour_features` gives it."""
    parts = spark.read.parquet(os.path.join(base, "parts"))
    if approximate:
        return parts.groupBy(*FEATURE_KEYS).agg(
            F.hll_sketch_estimate(F.hll_union_agg("vehicles")).alias("numAvailable"), F.sum("trips").alias("numTrips")).select(*FEATURE_COLUMNS)
    # A key has one row per 32,768 vehicles here, and then one row.
    merged = parts.groupBy(*FEATURE_KEYS, "bucket").agg(
        F.when(F.count("vehicles") > 0, F.bitmap_count(F.bitmap_or_agg("vehicles"))).alias("_n"), F.sum("trips").alias("_t"))
    return merged.groupBy(*FEATURE_KEYS).agg(F.sum("_n").alias("numAvailable"), F.sum("_t").alias("numTrips")).select(*FEATURE_COLUMNS)
