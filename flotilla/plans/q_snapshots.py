"""Workload B queries: snapshots and their comparison with the state."""

from __future__ import annotations

from pyspark.sql import functions as F

from flotilla.operators import snapshots as S
from flotilla.operators.state import initial_state
from flotilla.plans.catalog import register
from flotilla.plans.sqltext import POSITION_DOUBLES, positions_sql
from flotilla.schema import NUMERIC_TO_DOUBLE
from flotilla.session import fresh_path
from flotilla.sources import snapshot_index, tables
from flotilla.sources.fixture import FOLD_DAY, SNAPSHOT_ID, STATE_CUTOFF, positions

# Two fixture vehicles (present at every scale) for the two-vehicle query.
SUBSET_VEHICLES = ("V000001", "V000002")
FIRST_N = 4
TOP_N = 100

_ALL = dict(doubles=POSITION_DOUBLES, timestamps=["timestamp"], dates=["ingest_date"])

STATE_CTE = (
    "state AS (SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY matricula "
    f"ORDER BY epochTime DESC, event_id) AS rk FROM positions WHERE ingest_date <= DATE '{STATE_CUTOFF}') "
    "WHERE rk = 1)")
DAY_FILTER = (f"\"timestamp\" >= TIMESTAMP '{FOLD_DAY}' AND "
              f"\"timestamp\" < TIMESTAMP '{FOLD_DAY}' + INTERVAL 1 DAY")


# A state that doesn't know every plate: those ending in 0 or 5 are new to it.
YOUNG_STATE_CTE = STATE_CTE.replace("state AS (", "all_state AS (") + (
    ", state AS (SELECT * FROM all_state WHERE right(matricula, 1) NOT IN ('0', '5'))")


def state_of(spark, sf_dir):
    return initial_state(positions(spark, sf_dir), STATE_CUTOFF)


def young_state_of(spark, sf_dir):
    return state_of(spark, sf_dir).where(~F.substring("matricula", -1, 1).isin("0", "5"))


def snapshot_positions(spark, sf_dir, uoid):
    return S.snapshot_by_id(positions(spark, sf_dir), uoid)


@register("snapshot_by_id", positions_sql(f"SELECT * FROM positions WHERE uoid = '{SNAPSHOT_ID}'", **_ALL))
def snapshot_by_id(spark, sf_dir):
    """All rows of one snapshot."""
    return snapshot_positions(spark, sf_dir, SNAPSHOT_ID)


def _stored(spark, sf_dir):
    """The positions as a partitioned table, and its snapshot index."""
    path = fresh_path(spark, "positions")
    tables.write_positions(positions(spark, sf_dir), path)
    snapshot_index.write_index(tables.read_positions(spark, path), f"{path}-snapshots")
    return path, f"{path}-snapshots"


@register("snapshot_by_index", positions_sql(f"SELECT * FROM positions WHERE uoid = '{SNAPSHOT_ID}'", **_ALL))
def snapshot_by_index(spark, sf_dir):
    """A snapshot from the stored table, found by the index: only its dates'
    files are opened, and of those the pages that may hold it."""
    path, index = _stored(spark, sf_dir)
    return snapshot_index.read_snapshot(spark, path, index, SNAPSHOT_ID).select(*positions(spark, sf_dir).columns)


@register("snapshot_index", positions_sql(
    'SELECT uoid, realTime, min("timestamp") AS first_time, max("timestamp") AS last_time, count(*) AS "rows", ingest_date '
    "FROM positions GROUP BY uoid, realTime, ingest_date", dates=["ingest_date"], timestamps=["first_time", "last_time"]))
def snapshot_index_table(spark, sf_dir):
    """The snapshot index, written and read back."""
    return snapshot_index.read_index(spark, _stored(spark, sf_dir)[1])


@register("positions_numeric_cast", positions_sql(
    "SELECT event_id, " + ", ".join(f"cast({c} AS DOUBLE) AS {c}" for c in NUMERIC_TO_DOUBLE)
    + " FROM positions", doubles=NUMERIC_TO_DOUBLE))
def positions_numeric_cast(spark, sf_dir):
    """P5: the six NUMERIC columns as double (NULL kept)."""
    p = positions(spark, sf_dir)
    return S.cast_numeric(p.select("event_id", *NUMERIC_TO_DOUBLE))


@register("latest_snapshot_id", positions_sql(
    "SELECT uoid, epochTime FROM positions ORDER BY epochTime DESC, uoid DESC LIMIT 1"))
def latest_snapshot_id(spark, sf_dir):
    """O2: the newest snapshot id."""
    return S.latest_snapshot_id(positions(spark, sf_dir))


@register("snapshot_list", positions_sql(
    f"SELECT uoid, realTime FROM positions WHERE {DAY_FILTER} GROUP BY uoid, realTime"))
def snapshot_list(spark, sf_dir):
    """Distinct (uoid, realTime) of a day."""
    return S.snapshot_list(positions(spark, sf_dir), FOLD_DAY)


@register("snapshot_list_first_n", positions_sql(
    f"SELECT uoid, realTime FROM positions WHERE {DAY_FILTER} GROUP BY uoid, realTime "
    f"ORDER BY realTime, uoid LIMIT {FIRST_N}"))
def snapshot_list_first_n(spark, sf_dir):
    """O3: the first four entries of the day."""
    return S.snapshot_list_first_n(positions(spark, sf_dir), FOLD_DAY, FIRST_N)


@register("nth_snapshot", positions_sql(
    f"SELECT uoid, realTime FROM (SELECT uoid, realTime FROM positions WHERE {DAY_FILTER} "
    f"GROUP BY uoid, realTime ORDER BY realTime, uoid LIMIT {FIRST_N}) "
    "ORDER BY realTime DESC, uoid DESC LIMIT 1"))
def nth_snapshot(spark, sf_dir):
    """O3: the last of the first four entries -- the one the reference uses."""
    return S.nth_snapshot(positions(spark, sf_dir), FOLD_DAY, FIRST_N)


@register("snapshot_count", positions_sql(
    f"SELECT count(*) AS snapshot_rows FROM positions WHERE uoid = '{SNAPSHOT_ID}'"))
def snapshot_count(spark, sf_dir):
    """A2: COUNT(*) of a snapshot."""
    return snapshot_positions(spark, sf_dir, SNAPSHOT_ID).agg(
        F.count(F.lit(1)).alias("snapshot_rows"))


_DEDUPE_COLS = ["uoid", "matricula", "event_id", "realTime", "latitud", "longitud"]


@register("snapshot_dedupe", positions_sql(
    f"SELECT {', '.join(_DEDUPE_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY uoid, matricula "
    "ORDER BY realTime NULLS FIRST, event_id) AS rk FROM positions) WHERE rk = 1",
    doubles=["latitud", "longitud"]))
def snapshot_dedupe(spark, sf_dir):
    """One row per (uoid, plate), the oldest realTime wins (keep='first')."""
    return S.dedupe_snapshots(positions(spark, sf_dir), keep="first").select(*_DEDUPE_COLS)


@register("snapshot_movements", positions_sql(
    "SELECT p.event_id, p.matricula, CASE WHEN s.matricula IS NULL THEN 'new' "
    "WHEN p.latitud IS NOT DISTINCT FROM s.latitud AND p.longitud IS NOT DISTINCT FROM s.longitud "
    "THEN 'same' ELSE 'moved' END AS movement "
    f"FROM positions p LEFT JOIN state s ON p.matricula = s.matricula WHERE p.uoid = '{SNAPSHOT_ID}'",
    STATE_CTE))
def snapshot_movements(spark, sf_dir):
    """Every row of the snapshot classified against the stored state."""
    snap = snapshot_positions(spark, sf_dir, SNAPSHOT_ID)
    return S.compare_with_state(snap, state_of(spark, sf_dir)).select("event_id", "matricula", "movement")


@register("snapshot_movement_counts", positions_sql(
    "SELECT movement, count(*) AS plates FROM (SELECT p.matricula, CASE WHEN s.matricula IS NULL THEN 'new' "
    "WHEN p.latitud IS NOT DISTINCT FROM s.latitud AND p.longitud IS NOT DISTINCT FROM s.longitud "
    "THEN 'same' ELSE 'moved' END AS movement FROM (SELECT * FROM (SELECT *, row_number() OVER "
    "(PARTITION BY uoid, matricula ORDER BY realTime NULLS FIRST, event_id) AS rk FROM positions "
    f"WHERE uoid = '{SNAPSHOT_ID}') WHERE rk = 1) p LEFT JOIN state s ON p.matricula = s.matricula) "
    "GROUP BY movement", STATE_CTE))
def snapshot_movement_counts(spark, sf_dir):
    """Moved / same / new plates of the de-duplicated snapshot."""
    snap = S.dedupe_snapshots(snapshot_positions(spark, sf_dir, SNAPSHOT_ID))
    cmp = S.compare_with_state(snap, state_of(spark, sf_dir))
    return cmp.groupBy("movement").agg(F.count(F.lit(1)).alias("plates"))


@register("new_vehicles", positions_sql(
    f"SELECT event_id, matricula FROM positions p WHERE uoid = '{SNAPSHOT_ID}' "
    "AND NOT EXISTS (SELECT 1 FROM state s WHERE s.matricula = p.matricula)", STATE_CTE))
def new_vehicles(spark, sf_dir):
    """Snapshot rows of plates the state does not know."""
    snap = snapshot_positions(spark, sf_dir, SNAPSHOT_ID)
    return S.new_vehicles(snap, state_of(spark, sf_dir)).select("event_id", "matricula")


_COUNTS_SQL = (
    "SELECT movement, count(*) AS plates FROM (SELECT CASE WHEN s.matricula IS NULL THEN 'new' "
    "WHEN p.latitud IS NOT DISTINCT FROM s.latitud AND p.longitud IS NOT DISTINCT FROM s.longitud "
    "THEN 'same' ELSE 'moved' END AS movement FROM (SELECT * FROM (SELECT *, row_number() OVER "
    "(PARTITION BY uoid, matricula ORDER BY realTime NULLS FIRST, event_id) AS rk FROM positions "
    f"WHERE uoid = '{SNAPSHOT_ID}') WHERE rk = 1) p LEFT JOIN state s ON p.matricula = s.matricula) GROUP BY movement")


@register("snapshot_movement_counts_young_state", positions_sql(_COUNTS_SQL, YOUNG_STATE_CTE))
def snapshot_movement_counts_young_state(spark, sf_dir):
    """T3 against a state that lacks plates: all three classes can occur."""
    snap = S.dedupe_snapshots(snapshot_positions(spark, sf_dir, SNAPSHOT_ID))
    return S.compare_with_state(snap, young_state_of(spark, sf_dir)).groupBy("movement").agg(F.count(F.lit(1)).alias("plates"))


@register("new_vehicles_young_state", positions_sql(
    f"SELECT event_id, matricula FROM positions p WHERE uoid >= '{SNAPSHOT_ID}' "
    "AND NOT EXISTS (SELECT 1 FROM state s WHERE s.matricula = p.matricula)", YOUNG_STATE_CTE))
def new_vehicles_young_state(spark, sf_dir):
    """J3 against a state that lacks plates, all snapshots from one on."""
    snap = positions(spark, sf_dir).where(F.col("uoid") >= SNAPSHOT_ID)
    return S.new_vehicles(snap, young_state_of(spark, sf_dir)).select("event_id", "matricula")


@register("vehicles_subset", positions_sql(
    f"SELECT * FROM positions WHERE idVehiculo IN {SUBSET_VEHICLES!r} "
    "ORDER BY idVehiculo, epochTime, event_id LIMIT 2", **_ALL))
def vehicles_subset(spark, sf_dir):
    """two named vehicles, first two rows (LIMIT is the feature)."""
    p = positions(spark, sf_dir)
    return p.where(F.col("idVehiculo").isin(*SUBSET_VEHICLES)) \
            .orderBy("idVehiculo", "epochTime", "event_id").limit(2)


@register("positions_top_n", positions_sql(
    f"SELECT * FROM positions ORDER BY idVehiculo NULLS FIRST, epochTime, event_id LIMIT {TOP_N}", **_ALL))
def positions_top_n(spark, sf_dir):
    """ORDER BY idVehiculo, epochTime LIMIT 100 (distributed top-k)."""
    return positions(spark, sf_dir).orderBy("idVehiculo", "epochTime", "event_id").limit(TOP_N)
