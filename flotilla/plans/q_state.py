"""Workloads B and C queries: state table, upsert, fold, move log, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from flotilla.operators import replay as R
from flotilla.operators import snapshots as S
from flotilla.operators import state as ST
from flotilla.plans.catalog import register
from flotilla.plans.q_snapshots import (
    DAY_FILTER, STATE_CTE, YOUNG_STATE_CTE, snapshot_positions, state_of, young_state_of,
)
from flotilla.plans.sqltext import POSITION_DOUBLES, positions_sql
from flotilla.session import cut_lineage, fresh_path
from flotilla.sources import keyed_store, state_store, tables
from flotilla.sources.fixture import FOLD_DAY, SNAPSHOT_ID, positions
from flotilla.streaming import keyed_state as KS
from flotilla.streaming import live_state as LS

# The reference's write batch size.
WRITE_BATCH = 400

_ALL = dict(doubles=POSITION_DOUBLES, timestamps=["timestamp"], dates=["ingest_date"])
_FOLD_COLS = ["matricula", "event_id", "uoid", "realTime", "epochTime", "latitud", "longitud"]


def fold_ctes(add_new: bool = False, state: str = STATE_CTE) -> str:
    known = "" if add_new else "\n        WHERE s.matricula IN (SELECT matricula FROM state)"
    return state + f""",
entries AS (SELECT DISTINCT uoid, realTime AS e_rt FROM positions WHERE {DAY_FILTER}),
snap AS (SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY uoid, matricula
         ORDER BY realTime NULLS FIRST, event_id) AS rk FROM positions
         WHERE uoid IN (SELECT uoid FROM entries)) WHERE rk = 1),
obs AS (SELECT s.*, 1 AS k, e.e_rt AS e_rt, s.uoid AS e_u FROM snap s JOIN entries e ON s.uoid = e.uoid{known}),
u AS (SELECT *, 0 AS k, CAST(NULL AS VARCHAR) AS e_rt, CAST(NULL AS VARCHAR) AS e_u FROM state
      UNION ALL BY NAME SELECT * FROM obs),
l AS (SELECT *, lag(latitud) OVER w AS old_lat, lag(longitud) OVER w AS old_lon, row_number() OVER w AS pos
      FROM u WINDOW w AS (PARTITION BY matricula ORDER BY k, e_rt NULLS FIRST, e_u NULLS FIRST)),
ch AS (SELECT * FROM l WHERE pos = 1 OR latitud IS DISTINCT FROM old_lat OR longitud IS DISTINCT FROM old_lon)"""


FOLD_CTES = fold_ctes(add_new=False)
_FINAL_SQL = (f"SELECT {', '.join(_FOLD_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY matricula "
              "ORDER BY k DESC, e_rt DESC NULLS LAST, e_u DESC NULLS LAST) AS fk FROM ch) WHERE fk = 1")


@register("state_fold", positions_sql(_FINAL_SQL, FOLD_CTES, doubles=["latitud", "longitud"]))
def state_fold(spark, sf_dir):
    """State after replaying every snapshot of the day (known plates only)."""
    pos = positions(spark, sf_dir)
    return ST.fold_state(state_of(spark, sf_dir), pos, FOLD_DAY, add_new=False).select(*_FOLD_COLS)


@register("movement_log", positions_sql(
    "SELECT matricula, e_u AS entry_uoid, e_rt AS entry_realTime, event_id, old_lat AS old_latitud, "
    "old_lon AS old_longitud, latitud AS new_latitud, longitud AS new_longitud FROM ch WHERE pos > 1",
    FOLD_CTES, doubles=["old_latitud", "old_longitud", "new_latitud", "new_longitud"]))
def movement_log(spark, sf_dir):
    """Every accepted position change of the fold."""
    pos = positions(spark, sf_dir)
    return ST.movement_log(state_of(spark, sf_dir), pos, FOLD_DAY, add_new=False)


_UPSERT_CTE = STATE_CTE + f""",
upd AS (SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY uoid, matricula
        ORDER BY realTime NULLS FIRST, event_id) AS rk FROM positions WHERE uoid = '{SNAPSHOT_ID}') WHERE rk = 1)"""


@register("state_upsert", positions_sql(
    "SELECT * FROM upd UNION ALL SELECT * FROM state WHERE matricula NOT IN (SELECT matricula FROM upd)",
    _UPSERT_CTE, **_ALL))
def state_upsert(spark, sf_dir):
    """K4: upsert the de-duplicated snapshot into the stored state: a delta of its
    plates, merged on read."""
    base = fresh_path(spark, "state")
    state_store.write_version(state_of(spark, sf_dir), base, 0)
    snap = S.dedupe_snapshots(snapshot_positions(spark, sf_dir, SNAPSHOT_ID))
    state_store.write_delta(ST.upsert_delta(state_store.read_version(spark, base), snap), base, 1, f"snapshot:{SNAPSHOT_ID}")
    return state_store.read_version(spark, base)


@register("keyed_documents", positions_sql(
    f"SELECT {', '.join(_FOLD_COLS)} FROM (SELECT * FROM upd UNION ALL BY NAME SELECT * FROM state WHERE matricula NOT IN (SELECT matricula FROM upd))",
    _UPSERT_CTE, doubles=["latitud", "longitud"]))
def keyed_documents(spark, sf_dir):
    """K6: the state and then a snapshot's rows written as keyed documents, in batches
    that count from their commit on; read back as the newest of each key."""
    path = fresh_path(spark, "documents")
    state = state_of(spark, sf_dir).select(*_FOLD_COLS)
    keyed_store.write_documents(state, path, "matricula", WRITE_BATCH)
    snap = S.dedupe_snapshots(snapshot_positions(spark, sf_dir, SNAPSHOT_ID)).select(*_FOLD_COLS)
    keyed_store.write_documents(snap, path, "matricula", WRITE_BATCH)
    return keyed_store.read_documents(spark, path, state.schema).select("document.*")


_SERIES_SQL = f"""SELECT * EXCLUDE (rk, e_rt) FROM (SELECT *, row_number() OVER (PARTITION BY matricula ORDER BY e_rt DESC NULLS LAST, uoid DESC) AS rk FROM (
  SELECT *, CAST(NULL AS VARCHAR) AS e_rt FROM state UNION ALL BY NAME
  SELECT * EXCLUDE (rk, last_rt), last_rt AS e_rt FROM (SELECT p.*, last_rt, row_number() OVER (PARTITION BY p.uoid, matricula ORDER BY p.realTime NULLS FIRST, event_id) AS rk
    FROM positions p JOIN (SELECT uoid, max(realTime) AS last_rt FROM positions WHERE {DAY_FILTER} GROUP BY uoid) e ON p.uoid = e.uoid WHERE matricula IS NOT NULL) WHERE rk = 1)) WHERE rk = 1"""


@register("state_upsert_series", positions_sql(_SERIES_SQL, STATE_CTE, **_ALL))
def state_upsert_series(spark, sf_dir):
    """K4: every snapshot of a day upserted in turn, a delta each; compacted halfway,
    and a snapshot repeated."""
    base = fresh_path(spark, "state")
    state_store.write_version(state_of(spark, sf_dir), base, 0)
    pos = cut_lineage(positions(spark, sf_dir), "positions")
    day = S.snapshot_list(pos, FOLD_DAY).groupBy("uoid").agg(F.max("realTime").alias("rt")).orderBy("rt", "uoid").collect()  # the polls of a day
    steps = [r.uoid for r in day]
    for i, uoid in enumerate(steps + steps[-1:]):
        source, target = state_store.begin_step(spark, base, f"snapshot:{uoid}")
        snap = S.dedupe_snapshots(S.snapshot_by_id(pos, uoid))
        state_store.write_delta(ST.upsert_delta(state_store.read_version(spark, base, source), snap), base, target, f"snapshot:{uoid}")
        if 2 * i == len(steps) - len(steps) % 2:
            state_store.compact(spark, base)
    return state_store.read_version(spark, base)


@register("state_read", positions_sql("SELECT * FROM state", STATE_CTE, **_ALL))
def state_read(spark, sf_dir):
    """The state table read back, one row per plate."""
    out = fresh_path(spark, "state")
    state_of(spark, sf_dir).write.parquet(out)
    return spark.read.parquet(out)


@register("state_count", positions_sql("SELECT count(*) AS vehicles FROM state", STATE_CTE))
def state_count(spark, sf_dir):
    """A10: number of vehicles in the state."""
    return state_of(spark, sf_dir).agg(F.count(F.lit(1)).alias("vehicles"))


REPLAY_START, REPLAY_END = "2024-01-06", "2024-01-31"  # the days after the state's cutoff


def replay_ctes(add_new: bool = False, state: str = STATE_CTE) -> str:
    """The fold's SQL with entries by day."""
    sql = fold_ctes(add_new, state)
    for old, new in ((f"SELECT DISTINCT uoid, realTime AS e_rt FROM positions WHERE {DAY_FILTER}",
                      "SELECT DISTINCT CAST(\"timestamp\" AS DATE) AS e_day, uoid, realTime AS e_rt FROM positions "
                      f"WHERE CAST(\"timestamp\" AS DATE) BETWEEN DATE '{REPLAY_START}' AND DATE '{REPLAY_END}'"),
                     ("e.e_rt AS e_rt,", "e.e_day AS e_day, e.e_rt AS e_rt,"), ("0 AS k,", "0 AS k, CAST(NULL AS DATE) AS e_day,"),
                     ("ORDER BY k, e_rt", "ORDER BY k, e_day, e_rt")):
        assert old in sql
        sql = sql.replace(old, new)
    return sql


_REPLAYED_SQL = _FINAL_SQL.replace("ORDER BY k DESC,", "ORDER BY k DESC, e_day DESC,")


@register("state_replay", positions_sql(_REPLAYED_SQL, replay_ctes(), doubles=["latitud", "longitud"]))
def state_replay(spark, sf_dir):
    """T1 over a range of days in one run: segments by day, folded and combined."""
    return R.replay_state(state_of(spark, sf_dir), positions(spark, sf_dir), REPLAY_START, REPLAY_END).select(*_FOLD_COLS)


@register("state_replay_add_new_young_state", positions_sql(
    _REPLAYED_SQL, replay_ctes(True, YOUNG_STATE_CTE), doubles=["latitud", "longitud"]))
def state_replay_add_new_young_state(spark, sf_dir):
    """T1 over a range of days, plates the state lacks inserted at their first sighting."""
    return R.replay_state(young_state_of(spark, sf_dir), positions(spark, sf_dir), REPLAY_START, REPLAY_END, add_new=True).select(*_FOLD_COLS)


@register("movement_log_replay", positions_sql(
    "SELECT matricula, e_day AS day, e_u AS entry_uoid, e_rt AS entry_realTime, event_id, old_lat AS old_latitud, "
    "old_lon AS old_longitud, latitud AS new_latitud, longitud AS new_longitud FROM ch WHERE pos > 1",
    replay_ctes(), doubles=["old_latitud", "old_longitud", "new_latitud", "new_longitud"], dates=["day"]))
def movement_log_replay(spark, sf_dir):
    """T2 over a range of days: every accepted position change with its day."""
    ch = R.replay_changes(state_of(spark, sf_dir), positions(spark, sf_dir), REPLAY_START, REPLAY_END)
    return R.replay_log(ch)


@register("chunk_rows", positions_sql(
    f"SELECT event_id, (row_number() OVER (ORDER BY idVehiculo NULLS FIRST, epochTime, event_id) - 1) "
    f"// {WRITE_BATCH} AS batch_id FROM positions"))
def chunk_rows(spark, sf_dir):
    """K7: 400-row write batches over the whole table (every row, last batch too)."""
    p = positions(spark, sf_dir).select("event_id", "idVehiculo", "epochTime")
    return tables.chunk_rows(p, WRITE_BATCH).select("event_id", "batch_id")


@register("state_fold_add_new", positions_sql(_FINAL_SQL, fold_ctes(add_new=True),
                                              doubles=["latitud", "longitud"]))
def state_fold_add_new(spark, sf_dir):
    """T1 with D8's add_new=True: plates first seen during the day are inserted."""
    pos = positions(spark, sf_dir)
    return ST.fold_state(state_of(spark, sf_dir), pos, FOLD_DAY, add_new=True).select(*_FOLD_COLS)


@register("state_fold_young_state", positions_sql(
    _FINAL_SQL, fold_ctes(state=YOUNG_STATE_CTE), doubles=["latitud", "longitud"]))
def state_fold_young_state(spark, sf_dir):
    """T1 over a state that lacks plates: they are ignored."""
    return ST.fold_state(young_state_of(spark, sf_dir), positions(spark, sf_dir), FOLD_DAY).select(*_FOLD_COLS)


@register("state_fold_add_new_young_state", positions_sql(
    _FINAL_SQL, fold_ctes(True, YOUNG_STATE_CTE), doubles=["latitud", "longitud"]))
def state_fold_add_new_young_state(spark, sf_dir):
    """T1 with add_new over a state that lacks plates: they are inserted."""
    return ST.fold_state(young_state_of(spark, sf_dir), positions(spark, sf_dir), FOLD_DAY, add_new=True).select(*_FOLD_COLS)


@register("live_state", positions_sql(_FINAL_SQL, fold_ctes(add_new=True),
                                      doubles=["latitud", "longitud"]))
def live_state(spark, sf_dir):
    """T4: the day's snapshots arrive as files in two drops; a file stream
    with foreachBatch folds each micro-batch into a versioned state."""
    base = fresh_path(spark, "live")
    pos = positions(spark, sf_dir)
    LS.write_initial_state(state_of(spark, sf_dir), base)
    day = pos.where(S.day_filter(FOLD_DAY))
    noon = F.lit(f"{FOLD_DAY} 12:00:00")
    feed = f"{base}/feed"
    for drop in (F.col("realTime") < noon, F.col("realTime") >= noon):   # whole 6 h snapshots
        day.where(drop).write.mode("append").parquet(feed)
        LS.run_available(spark, feed, base, pos.schema)
    return LS.read_state(spark, base).select(*_FOLD_COLS)


@register("live_state_keyed", positions_sql(_FINAL_SQL, fold_ctes(add_new=True), doubles=["latitud", "longitud"]))
def live_state_keyed(spark, sf_dir):
    """T4 with the state in the stream: the day's snapshots in two drops, a value per plate."""
    base = fresh_path(spark, "live-keyed")
    pos, state = positions(spark, sf_dir), cut_lineage(state_of(spark, sf_dir), "first-state")
    day, feed = pos.where(S.day_filter(FOLD_DAY)), f"{base}/feed"
    noon = F.lit(f"{FOLD_DAY} 12:00:00")
    for drop in (F.col("realTime") < noon, F.col("realTime") >= noon):   # whole 6 h snapshots
        day.where(drop).write.mode("append").parquet(feed)
        KS.run_available(spark, feed, base, pos.schema, state)
    return KS.current_state(spark, base, pos.schema, state).select(*_FOLD_COLS)
