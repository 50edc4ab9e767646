"""Workload A queries: pairing, distance, trips."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from flotilla.functions.geo import pair_distance_km, pair_distance_sql
from flotilla.operators import pairs as P
from flotilla.operators.trips import extract_trips, last_rows_before, position_pairs
from flotilla.plans.catalog import register
from flotilla.plans.present import sql_present
from flotilla.plans.sqltext import TRIP_DOUBLES, TRIP_TIMESTAMPS, pairs_cte, positions_sql, trips_sql
from flotilla.session import fresh_path
from flotilla.sources import bucketed
from flotilla.sources.fixture import RANGE_END, RANGE_START, positions

_KEYS = ["event_id", "idVehiculo", "epochTime"]


@register("trips_vehicle", trips_sql("vehicle", compat=False))
def trips_vehicle(spark, sf_dir):
    """Per-vehicle pairs, both ends measurable, > 0.1 km, 30 trip columns."""
    return extract_trips(positions(spark, sf_dir), pairing="vehicle", compat=False)


@register("trips_vehicle_compat", trips_sql("vehicle", compat=True))
def trips_vehicle_compat(spark, sf_dir):
    """Per-vehicle pairs with the reference's missing-end-as-zero distance."""
    return extract_trips(positions(spark, sf_dir), pairing="vehicle", compat=True)


@register("trips_global_compat", trips_sql("global", compat=True))
def trips_global_compat(spark, sf_dir):
    """The reference job bit for bit: global order, compat distance and copies."""
    return extract_trips(positions(spark, sf_dir), pairing="global", compat=True)


@register("trips_incremental", sql_present(
    f"SELECT * FROM ({trips_sql('vehicle', present=False)}) t WHERE cast(timestamp_end AS DATE) "
    f"BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'",
    doubles=TRIP_DOUBLES, timestamps=TRIP_TIMESTAMPS))
def trips_incremental(spark, sf_dir):
    """Incremental run over a date range: only that range is paired, with
    each vehicle's last earlier row carried in -- equal to the trips of a
    run over everything that end inside the range. Here the carry-in is
    derived from the history before the range; a production run takes it
    from the state table (one row per vehicle) instead of rescanning."""
    rng = positions(spark, sf_dir, RANGE_START, RANGE_END)
    carry = last_rows_before(positions(spark, sf_dir, end=_day_before(RANGE_START)), RANGE_START)
    return extract_trips(rng, carry_in=carry)


def _day_before(day: str) -> str:
    return (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()


_PAIRS_SQL = positions_sql(
    "SELECT idVehiculo, s_event_id AS event_id_start, event_id AS event_id_end, "
    "s_epochTime AS epochTime_start, epochTime AS epochTime_end FROM pairs WHERE rn > 1",
    pairs_cte("vehicle"))


@register("position_pairs", _PAIRS_SQL)
def position_pairs_q(spark, sf_dir):
    """Each position with the previous one of the same vehicle."""
    pr = position_pairs(positions(spark, sf_dir), "vehicle", columns=())
    return pr.select(F.col("e.idVehiculo").alias("idVehiculo"),
                     F.col("s.event_id").alias("event_id_start"),
                     F.col("e.event_id").alias("event_id_end"),
                     F.col("s.epochTime").alias("epochTime_start"),
                     F.col("e.epochTime").alias("epochTime_end"))


@register("position_pairs_stored", _PAIRS_SQL)
def position_pairs_stored(spark, sf_dir):
    """J1 over positions stored by vehicle, in two writes of which the second is repeated:
    the window runs in the scan's tasks."""
    path = fresh_path(spark, "by-vehicle")
    cols = [*_KEYS, "ingest_date"]
    bucketed.write_bucketed(positions(spark, sf_dir, end=_day_before(RANGE_START)).select(*cols), path, buckets=8)
    for _ in range(2):
        bucketed.write_bucketed(positions(spark, sf_dir, RANGE_START).select(*cols), path)
    pr = bucketed.previous_stored(spark, path, _KEYS).where(F.col("prev").isNotNull())
    return pr.select("idVehiculo", F.col("prev.event_id").alias("event_id_start"), F.col("event_id").alias("event_id_end"),
                     F.col("prev.epochTime").alias("epochTime_start"), F.col("epochTime").alias("epochTime_end"))


_HAV_SQL = positions_sql(
    "SELECT s_event_id AS event_id_start, event_id AS event_id_end, "
    f"{pair_distance_sql('s_latitud', 's_longitud', 'latitud', 'longitud', False)} AS dist_strict, "
    f"{pair_distance_sql('s_latitud', 's_longitud', 'latitud', 'longitud', True)} AS dist_compat "
    "FROM pairs WHERE rn > 1", pairs_cte("vehicle"), doubles=["dist_strict", "dist_compat"])


@register("haversine_pairs", _HAV_SQL)
def haversine_pairs(spark, sf_dir):
    """Distance of every per-vehicle pair, strict and compat, unfiltered."""
    pr = position_pairs(positions(spark, sf_dir), "vehicle", columns=("latitud", "longitud"))
    args = (F.col("s.latitud"), F.col("s.longitud"), F.col("e.latitud"), F.col("e.longitud"))
    return pr.select(F.col("s.event_id").alias("event_id_start"),
                     F.col("e.event_id").alias("event_id_end"),
                     pair_distance_km(*args, compat=False).alias("dist_strict"),
                     pair_distance_km(*args, compat=True).alias("dist_compat"))


_GRN_SQL = positions_sql(
    "SELECT event_id, idVehiculo, epochTime, row_number() OVER "
    "(ORDER BY idVehiculo NULLS FIRST, epochTime, event_id) AS tempField FROM positions")


@register("global_row_number", _GRN_SQL)
def global_row_number(spark, sf_dir):
    """ROW_NUMBER over (idVehiculo, epochTime) across the whole table."""
    return P.row_numbers(positions(spark, sf_dir).select(*_KEYS), scope="global")


_VRN_SQL = positions_sql(
    "SELECT event_id, idVehiculo, epochTime, row_number() OVER "
    "(PARTITION BY idVehiculo ORDER BY epochTime, event_id) AS tempField FROM positions")


@register("vehicle_row_number", _VRN_SQL)
def vehicle_row_number(spark, sf_dir):
    """ROW_NUMBER per vehicle in time order."""
    return P.row_numbers(positions(spark, sf_dir).select(*_KEYS), scope="vehicle")


_SHIFT_CTE = ("numbered AS (SELECT event_id, idVehiculo, epochTime, row_number() OVER "
              "(ORDER BY idVehiculo NULLS FIRST, epochTime, event_id) AS tempField FROM positions), "
              "shifted AS (SELECT * FROM numbered WHERE tempField <> 1 UNION ALL "
              "SELECT event_id, idVehiculo, epochTime, tempField + 1 FROM numbered)")


@register("positions_union_shift", positions_sql("SELECT * FROM shifted", _SHIFT_CTE))
def positions_union_shift(spark, sf_dir):
    """Numbered rows UNION ALL the same rows numbered + 1."""
    return P.union_shift(positions(spark, sf_dir).select(*_KEYS))


@register("pairs_by_group", positions_sql(
    "SELECT tempField, count(*) AS n_rows, "
    "arg_min(event_id, (epochTime, event_id)) AS start_event_id, "
    "arg_max(event_id, (epochTime, event_id)) AS end_event_id FROM shifted GROUP BY tempField",
    _SHIFT_CTE))
def pairs_by_group(spark, sf_dir):
    """A1: the reference's GroupByKey over the shifted numbering."""
    return P.pairs_by_group(P.union_shift(positions(spark, sf_dir).select(*_KEYS)))


@register("pair_key", positions_sql(
    "SELECT event_id, concat(idVehiculo, '*', cast(tempField AS VARCHAR)) AS pair_key "
    "FROM numbered", _SHIFT_CTE.split(", shifted AS")[0]))
def pair_key(spark, sf_dir):
    """Composite key idVehiculo*tempField (unused helper in the reference)."""
    n = P.row_numbers(positions(spark, sf_dir).select(*_KEYS), scope="global")
    return n.select("event_id", F.concat_ws("*", "idVehiculo", F.col("tempField").cast("string"))
                    .alias("pair_key"))


_METRICS_SQL = positions_sql(
    "SELECT (SELECT count(*) FROM positions) AS rows_in, "
    "count(*) AS pairs, "
    f"count({pair_distance_sql('s_latitud', 's_longitud', 'latitud', 'longitud', False)}) AS measurable, "
    f"count(*) FILTER (WHERE {pair_distance_sql('s_latitud', 's_longitud', 'latitud', 'longitud', False)}"
    " > 1e-1) AS trips FROM pairs WHERE rn > 1", pairs_cte("vehicle"))


@register("trips_metrics", _METRICS_SQL)
def trips_metrics(spark, sf_dir):
    """V1: pipeline counters (rows in, pairs, measurable pairs, trips) as one row."""
    pos = positions(spark, sf_dir)
    cols = ["event_id", "idVehiculo", "epochTime", "latitud", "longitud"]
    pr = P.attach_previous(pos.select(*cols), scope="vehicle", prev_col="s")
    d = pair_distance_km(F.col("s.latitud"), F.col("s.longitud"), F.col("latitud"), F.col("longitud"))
    return pr.agg(F.count(F.lit(1)).alias("rows_in"), F.count("s").alias("pairs"),
                  F.count(d).alias("measurable"), F.count(F.when(d > F.lit(0.1), 1)).alias("trips"))
