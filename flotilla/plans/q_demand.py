"""Workload D queries: feature view, cleaning, group tables, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from flotilla.operators import evaluate as E
from flotilla.operators import features as FT
from flotilla.operators.trips import extract_trips
from flotilla.plans.catalog import register
from flotilla.plans.sqltext import (
    CLEAN_CTE, FEATURES_CTES, hash_bucket_sql, positions_sql,
)
from flotilla.plans.studies import KEY, features_from, study_input
from flotilla.session import fresh_path
from flotilla.sources import feature_store
from flotilla.sources.fixture import RANGE_START, positions

HEAD_N, TAIL_N = 5, 20
# The six columns of the per-type table.
TYPE_TABLE_COLUMNS = ["tipoVehiculo", "weekday", "hour", "clusterId", "numAvailable", "numTrips"]
CLEAN_COLUMNS = ["servicio", "tipoVehiculo", "weekday", "hour", "clusterId", "numAvailable", "numTrips"]

KEYED_CTE = FEATURES_CTES + """,
cleank AS (SELECT servicio, tipoVehiculo, weekday, "hour", clusterId, numAvailable,
           coalesce(numTrips, 0) AS numTrips, CAST(coalesce(numTrips, 0) > 0 AS DOUBLE) AS tripYesNo,
           concat_ws('|', servicio, tipoVehiculo, cast(year AS VARCHAR), cast(month AS VARCHAR),
                     cast(day AS VARCHAR), cast("hour" AS VARCHAR), cast(clusterId AS VARCHAR)) AS row_key
           FROM features WHERE weekday = 'Thursday' AND numAvailable <> 0),
split AS (SELECT *, """ + hash_bucket_sql("row_key", 100) + """ < 75 AS is_train FROM cleank)"""

_FEAT_DOUBLES = ["clusterLatitude", "clusterLongitude"]


@register("cluster_hour_features", positions_sql(
    "SELECT * FROM features", FEATURES_CTES, doubles=_FEAT_DOUBLES))
def cluster_hour_features(spark, sf_dir):
    """Availability and trips per (service, type, day, hour, cluster)."""
    return features_from(spark, sf_dir).select(*FT.FEATURE_COLUMNS)


@register("feature_view_increments", positions_sql(
    "SELECT * FROM features", FEATURES_CTES, doubles=_FEAT_DOUBLES))
def feature_view_increments(spark, sf_dir):
    """A8 by increments: the dates up to a day, the later ones, the later ones again.
    Every other row comes a day late, so hours are seen on two dates."""
    base = fresh_path(spark, "features")
    p = positions(spark, sf_dir)
    late = p.withColumn("ingest_date", F.date_add("ingest_date", (F.col("event_id") % 2).cast("int")))
    trips = extract_trips(p, compat=True, with_date=True)
    for early in (True, False, False):
        def run(c): return (F.col(c) <= F.lit(RANGE_START).cast("date")) == F.lit(early)
        feature_store.write_increment(late.where(run("ingest_date")), trips.where(run("trip_date")), base)
    return feature_store.read_view(spark, base)


@register("calendar_parts", positions_sql(
    'SELECT event_id, cast("timestamp" AS DATE) AS "date", year("timestamp") AS year, '
    'month("timestamp") AS month, day("timestamp") AS day, dayname("timestamp") AS weekday, '
    'hour("timestamp") AS "hour" FROM positions', dates=["date"]))
def calendar_parts(spark, sf_dir):
    """Date parts of the poll time."""
    p = positions(spark, sf_dir)
    return p.select("event_id", *FT.calendar_parts(F.col("timestamp")))


@register("weekday_number", positions_sql(
    'SELECT event_id, dayname("timestamp") AS weekday, isodow("timestamp") AS weekday_number FROM positions'))
def weekday_number(spark, sf_dir):
    """Weekday name -> number, Monday = 1."""
    p = positions(spark, sf_dir).select("event_id", F.date_format("timestamp", "EEEE").alias("weekday"))
    return p.withColumn("weekday_number", FT.weekday_number(F.col("weekday")))


@register("demand_features_clean", positions_sql(
    f"SELECT {', '.join(chr(34) + c + chr(34) for c in CLEAN_COLUMNS)} FROM clean", FEATURES_CTES + ",\n" + CLEAN_CTE))
def demand_features_clean(spark, sf_dir):
    """Thursday, availability present, NULL trips -> 0, columns dropped."""
    return FT.clean_demand(features_from(spark, sf_dir)).select(*CLEAN_COLUMNS)


@register("demand_label_yes_no", positions_sql(
    "SELECT *, numTrips > 0 AS tripYesNo FROM clean", FEATURES_CTES + ",\n" + CLEAN_CTE))
def demand_label_yes_no(spark, sf_dir):
    """Binary label 'a trip happens'."""
    return FT.label_yes_no(FT.clean_demand(features_from(spark, sf_dir)).select(*CLEAN_COLUMNS))


_COUNT_COLS = [c for c in FT.FEATURE_COLUMNS if c != "numTrips"]


@register("count_by_num_trips", positions_sql(
    "SELECT numTrips, " + ", ".join(f'count("{c}") AS "{c}"' for c in _COUNT_COLS)
    + " FROM features WHERE numTrips IS NOT NULL GROUP BY numTrips", FEATURES_CTES))
def count_by_num_trips(spark, sf_dir):
    """A4: groupby('numTrips').count() -- non-NULL counts of the other columns."""
    return FT.count_by(features_from(spark, sf_dir).select(*FT.FEATURE_COLUMNS), "numTrips")


@register("demand_by_vehicle_type", positions_sql(
    f"SELECT tipoVehiculo, count(*) AS n_rows, count(*) * {len(TYPE_TABLE_COLUMNS)} AS size "
    "FROM clean GROUP BY tipoVehiculo", FEATURES_CTES + ",\n" + CLEAN_CTE))
def demand_by_vehicle_type(spark, sf_dir):
    """Rows and frame size per vehicle type, one pass."""
    clean = FT.clean_demand(features_from(spark, sf_dir)).select(*TYPE_TABLE_COLUMNS)
    return FT.size_by_type(clean, len(TYPE_TABLE_COLUMNS))


@register("num_trips_mean", positions_sql(
    "SELECT avg(numTrips) AS numTrips_mean FROM clean WHERE tipoVehiculo = 'moto'",
    FEATURES_CTES + ",\n" + CLEAN_CTE, doubles=["numTrips_mean"]))
def num_trips_mean(spark, sf_dir):
    """Mean trips of the moto rows."""
    clean = FT.clean_demand(features_from(spark, sf_dir)).where(F.col("tipoVehiculo") == "moto")
    return clean.agg(F.avg("numTrips").alias("numTrips_mean"))


_ORDER = ["servicio", "tipoVehiculo", "year", "month", "day", "hour", "clusterId"]


@register("head_n", positions_sql(
    f"SELECT * FROM features ORDER BY {', '.join(chr(34) + c + chr(34) for c in _ORDER)} LIMIT {HEAD_N}",
    FEATURES_CTES, doubles=_FEAT_DOUBLES))
def head_n(spark, sf_dir):
    """head() in an explicit order (a DataFrame has no row order)."""
    return features_from(spark, sf_dir).select(*FT.FEATURE_COLUMNS).orderBy(*_ORDER).limit(HEAD_N)


@register("drop_last_n", positions_sql(
    f"SELECT * EXCLUDE (tripYesNo) FROM cleank WHERE tipoVehiculo = 'moto' AND row_key NOT IN "
    f"(SELECT row_key FROM cleank WHERE tipoVehiculo = 'moto' ORDER BY row_key DESC LIMIT {TAIL_N})",
    KEYED_CTE.split(",\nsplit AS")[0]))
def drop_last_n(spark, sf_dir):
    """head(-20) = all rows but the last 20 in key order: the last 20
    (a distributed top-k) are anti-joined away; no global numbering."""
    moto = study_input(features_from(spark, sf_dir), "moto").drop("tripYesNo")
    last = moto.orderBy(F.col(KEY).desc()).limit(TAIL_N).select(KEY)
    return moto.join(F.broadcast(last), KEY, "left_anti")   # at most TAIL_N rows


@register("concat_cast", positions_sql(
    "SELECT event_id, concat('questions/', cast(event_id AS VARCHAR)) AS url FROM positions"))
def concat_cast(spark, sf_dir):
    """CONCAT(prefix, CAST(id AS STRING))."""
    return positions(spark, sf_dir).select(
        "event_id", F.concat(F.lit("questions/"), F.col("event_id").cast("string")).alias("url"))


@register("like_filter", positions_sql(
    "SELECT event_id, tipo FROM positions WHERE tipo LIKE '%rr%'"))
def like_filter(spark, sf_dir):
    """LIKE '%x%' filter."""
    return positions(spark, sf_dir).where(F.col("tipo").like("%rr%")).select("event_id", "tipo")


@register("train_test_split", positions_sql(
    "SELECT row_key, is_train FROM split", KEYED_CTE))
def train_test_split(spark, sf_dir):
    """M1: reproducible 75/25 split on a hash of the row key."""
    return E.with_split(study_input(features_from(spark, sf_dir)), [KEY]).select(KEY, "is_train")


@register("cv_fold_sizes", positions_sql(
    "SELECT cast(r AS BIGINT) AS repeat, " + hash_bucket_sql("concat(cast(r AS VARCHAR), '|', row_key)", 10)
    + " AS fold, count(*) AS n FROM split, (SELECT unnest([0, 1, 2]) AS r) reps "
    "WHERE tipoVehiculo = 'moto' AND is_train GROUP BY ALL", KEYED_CTE))
def cv_fold_sizes(spark, sf_dir):
    """M8: fold sizes of the 10 x 3 repeated K-fold over the moto training rows."""
    data = E.with_split(study_input(features_from(spark, sf_dir), "moto"), [KEY]).where(F.col("is_train"))
    reps = data.select(KEY, F.explode(F.array(*[F.lit(r) for r in range(E.CV_REPEATS)])).alias("repeat"))
    key = F.concat(F.col("repeat").cast("string"), F.lit("|"), F.col(KEY))
    return reps.select("repeat", E.hash_bucket(key, E.CV_FOLDS).alias("fold")) \
               .groupBy("repeat", "fold").agg(F.count(F.lit(1)).alias("n"))
