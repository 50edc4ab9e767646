"""Trip extraction: consecutive positions -> distance -> movement filter -> trip row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flotilla.functions.geo import MIN_TRIP_KM, pair_distance_km
from flotilla.operators.pairs import attach_previous, order_in
from flotilla.schema import POSITION_COLUMNS, TRIP_COLUMNS

# Columns of a trip taken once, from the start row.
_FROM_START = ["servicio", "idVehiculo", "matricula", "precio", "tipo", "categoria",
               "imagen", "uoid", "tipoVehiculo"]
# Columns taken from both rows with _start / _end suffixes.
_BOTH = ["energia", "latitud", "longitud", "epochTime", "realTime", "geo", "clusterId",
         "clusterLatitude", "clusterLongitude", "timestamp"]


# What pairing itself needs: the vehicle and the order of its positions.
PAIR_ORDER = ("idVehiculo", "epochTime", "realTime", "uoid")


def position_pairs(positions: DataFrame, pairing: str = "vehicle",
                   extra: tuple = (), columns: tuple | None = None) -> DataFrame:
    """(start, end) pairs of consecutive positions as two structs ``s`` and ``e``.

    pairing='vehicle' pairs within a vehicle; 'global' reproduces the
    reference's single ordering in which pairs cross vehicle borders.
    ``columns`` names the position columns a caller needs: rows travel whole,
    so Catalyst can't drop the others by itself.
    """
    wanted = ["event_id", *(POSITION_COLUMNS if columns is None else columns)]
    keep = [c for c in dict.fromkeys([*wanted, *PAIR_ORDER]) if c in positions.columns] + list(extra)
    paired = attach_previous(positions.select(*keep), scope=pairing, prev_col="s")
    return paired.where(F.col("s").isNotNull()).select(
        "s", F.struct(*[F.col(c) for c in keep]).alias("e"))


def shape_trips(pairs: DataFrame, compat: bool = False, min_km: float = MIN_TRIP_KM,
                with_ids: bool = False, with_date: bool = False) -> DataFrame:
    """Distance, movement filter (> ``min_km``, strict) and the 30 trip columns.

    compat=True keeps the reference's quirks: a missing end coordinate
    counts as 0, and epochTime_end / realTime_end are copied from the start.
    """
    dist = pair_distance_km(F.col("s.latitud"), F.col("s.longitud"),
                            F.col("e.latitud"), F.col("e.longitud"), compat=compat)
    cols = {"distancia": F.col("distancia")}
    for c in _FROM_START:
        cols[c] = F.col(f"s.{c}")
    for c in _BOTH:
        cols[f"{c}_start"] = F.col(f"s.{c}")
        cols[f"{c}_end"] = F.col(f"e.{c}")
    if compat:
        cols["epochTime_end"] = F.col("s.epochTime")
        cols["realTime_end"] = F.col("s.realTime")
    ordered = [cols[c].alias(c) for c in TRIP_COLUMNS]
    if with_ids:
        ordered += [F.col("s.event_id").alias("event_id_start"), F.col("e.event_id").alias("event_id_end")]
    if with_date:
        ordered.append(F.col("e.ingest_date").alias("trip_date"))
    # NULL distance (unmeasurable pair) fails the comparison and is dropped.
    return (pairs.withColumn("distancia", dist)
                 .where(F.col("distancia") > F.lit(min_km))
                 .select(*ordered))


def extract_trips(positions: DataFrame, pairing: str = "vehicle", compat: bool = False,
                  min_km: float = MIN_TRIP_KM, with_ids: bool = False,
                  carry_in: DataFrame | None = None, with_date: bool = False) -> DataFrame:
    """Workload A end to end: positions -> trips (one row per movement).

    ``carry_in``: for an incremental run over a time range, the last row of
    each vehicle before the range (:func:`last_rows` of what came before; the
    plate state isn't one: it keeps the first row of a position). Its rows only serve as start rows, so the
    first position of a vehicle in the range pairs with its true
    predecessor and consecutive ranges together give the same trips as one
    run over everything. ``with_date`` adds ``trip_date``, the ingestion date of
    the end row.
    """
    more = ("ingest_date",) if with_date else ()
    if carry_in is None or pairing != "vehicle":
        if carry_in is not None:
            raise ValueError("carry_in applies to per-vehicle pairing")
        return shape_trips(position_pairs(positions, pairing, extra=more), compat, min_km, with_ids, with_date)
    keep = [c for c in ["event_id", *POSITION_COLUMNS, *more] if c in positions.columns]
    both = (positions.select(*keep, F.lit(False).alias("_carried"))
            .unionByName(carry_in.select(*keep, F.lit(True).alias("_carried"))))
    pairs = position_pairs(both, pairing, extra=("_carried", *more))
    pairs = pairs.where(~F.col("e._carried"))
    return shape_trips(pairs, compat, min_km, with_ids, with_date)


def trip_starts(positions: DataFrame, compat: bool = False, min_km: float = MIN_TRIP_KM) -> DataFrame:
    """Where and when trips start: the six trip columns the feature view counts,
    paired from eight position columns only."""
    place = ["servicio", "tipoVehiculo", "timestamp", "clusterId", "clusterLatitude", "clusterLongitude"]
    pairs = position_pairs(positions, columns=(*place, "latitud", "longitud"))
    dist = pair_distance_km(F.col("s.latitud"), F.col("s.longitud"), F.col("e.latitud"), F.col("e.longitud"), compat=compat)
    return pairs.where(dist > F.lit(min_km)).select(
        *[F.col(f"s.{c}").alias(c if c in _FROM_START else f"{c}_start") for c in place])


def last_rows(positions: DataFrame, entity: str = "idVehiculo") -> DataFrame:
    """Last row of every vehicle in the pairing order (partial ``max_by``
    aggregate; one row per vehicle)."""
    row = F.struct(*[F.col(c) for c in positions.columns])
    key = F.struct(*[F.col(c) for c in order_in(positions)])
    return positions.groupBy(entity).agg(F.max_by(row, key).alias("_r")).select("_r.*")


def last_rows_before(positions: DataFrame, start: str, entity: str = "idVehiculo") -> DataFrame:
    """Last row of every vehicle with a poll before ``start``."""
    return last_rows(positions.where(F.col("timestamp") < F.lit(start).cast("timestamp_ntz")), entity)
