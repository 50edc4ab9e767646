"""Hourly cluster features and the demand-study table operations (workload D).

The reference reads a warehouse view whose SQL is not published; its
columns are known. Our definition (kept in one place, here):

* ``numAvailable`` = distinct vehicles seen per (servicio, tipoVehiculo,
  date, hour, cluster) -- from positions;
* ``numTrips`` = trips starting in that cluster and hour;
* both sides combined as a full outer join on the keys: a measure with no
  rows is NULL. The combine is a union of the two pre-aggregated sides
  followed by one aggregate, which groups NULL keys together and needs no
  join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURE_KEYS = ["servicio", "tipoVehiculo", "year", "month", "day", "weekday", "hour",
                "clusterId", "clusterLatitude", "clusterLongitude"]
FEATURE_COLUMNS = [*FEATURE_KEYS, "numAvailable", "numTrips"]
# Weekday names and their numbers (Monday = 1).
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# Vehicle types of the fleet.
VEHICLE_TYPES = ["coche", "patinete", "moto"]
# Columns dropped by the cleaning step.
CLEAN_DROPPED = ["year", "month", "day", "clusterLatitude", "clusterLongitude"]


def calendar_parts(ts: Column, prefix: str = "") -> list[Column]:
    """date, year, month, day, weekday name and hour of a timestamp."""
    d = F.to_date(ts)
    return [d.alias(f"{prefix}date"), F.year(d).alias(f"{prefix}year"),
            F.month(d).alias(f"{prefix}month"), F.dayofmonth(d).alias(f"{prefix}day"),
            F.date_format(d, "EEEE").alias(f"{prefix}weekday"),
            F.hour(ts).alias(f"{prefix}hour")]


def weekday_number(name: Column) -> Column:
    """Weekday name -> 1..7 (Monday = 1); unknown names -> NULL."""
    pairs = []
    for i, n in enumerate(WEEKDAYS, start=1):
        pairs += [F.lit(n), F.lit(i)]
    return F.create_map(*pairs)[name]


def keyed(df: DataFrame, ts: str, cluster: str, lat: str, lon: str, extra: list[Column]) -> DataFrame:
    """The feature keys of rows with a time and a cluster, and the ``extra`` columns."""
    return df.select(F.col("servicio"), F.col("tipoVehiculo"), *calendar_parts(F.col(ts)),
                     F.col(cluster).alias("clusterId"), F.col(lat).alias("clusterLatitude"),
                     F.col(lon).alias("clusterLongitude"), *extra).drop("date")


def cluster_hour_features(positions: DataFrame, trips: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """The feature view: one row per (servicio, type, date, hour, cluster).

    ``numAvailable`` is exact by default (distinct (key, vehicle) pairs,
    de-duplicated map-side, then counted). ``approx_rsd`` switches to one
    HyperLogLog aggregate (``approx_count_distinct``) with that relative
    standard deviation: one shuffle less at scale, counts approximate.
    """
    placed = keyed(positions, "timestamp", "clusterId", "clusterLatitude", "clusterLongitude",
                   [F.col("idVehiculo")])
    if approx_rsd is None:
        seen = (placed.distinct()                                  # one row per vehicle and key
                .groupBy(*FEATURE_KEYS).agg(F.count("idVehiculo").alias("_avail")))
    else:
        seen = placed.groupBy(*FEATURE_KEYS).agg(
            F.approx_count_distinct("idVehiculo", approx_rsd).alias("_avail"))
    moved = (keyed(trips, "timestamp_start", "clusterId_start", "clusterLatitude_start",
                    "clusterLongitude_start", [])
             .groupBy(*FEATURE_KEYS).agg(F.count(F.lit(1)).alias("_trips")))
    both = (seen.withColumn("_trips", F.lit(None).cast("bigint"))
                .unionByName(moved.withColumn("_avail", F.lit(None).cast("bigint"))))
    return both.groupBy(*FEATURE_KEYS).agg(
        F.sum("_avail").alias("numAvailable"), F.sum("_trips").alias("numTrips"))


# A unique row key of the feature view (cluster coordinates follow from clusterId).
ROW_KEY_COLUMNS = ["servicio", "tipoVehiculo", "year", "month", "day", "hour", "clusterId"]


def clean_demand(features: DataFrame, weekday: str | None = "Thursday",
                 key_col: str | None = None) -> DataFrame:
    """Filter one weekday, drop rows without availability (0 or NULL), NULL
    trips -> 0, drop the calendar and cluster-coordinate columns.
    ``key_col`` keeps a unique row key (for reproducible splits)."""
    df = features
    if key_col:
        df = df.withColumn(key_col, F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                                       for c in ROW_KEY_COLUMNS]))
    if weekday is not None:
        df = df.where(F.col("weekday") == F.lit(weekday))
    return (df.where(F.col("numAvailable") != 0)
              .na.fill(0, ["numTrips"])
              .drop(*CLEAN_DROPPED))


def label_yes_no(df: DataFrame, label: str = "numTrips", out: str = "tripYesNo") -> DataFrame:
    return df.withColumn(out, F.col(label) > 0)


def count_by(df: DataFrame, key: str) -> DataFrame:
    """pandas ``groupby(key).count()``: non-NULL count of every other column;
    rows with a NULL key are dropped."""
    others = [c for c in df.columns if c != key]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.count(F.col(c)).alias(c) for c in others])


def size_by_type(df: DataFrame, ncols: int, col: str = "tipoVehiculo") -> DataFrame:
    """Rows and ``DataFrame.size`` (rows x columns) per vehicle type, one pass."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"),
                               (F.count(F.lit(1)) * F.lit(ncols)).alias("size"))

