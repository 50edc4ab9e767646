"""State fold, move log and upsert: edge rows and a plain driver loop."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.operators import snapshots as S
from flotilla.operators import state as ST
from flotilla.sources.fixture import FOLD_DAY, STATE_CUTOFF, positions

SCHEMA = ("matricula string, event_id long, uoid string, realTime string, latitud double, "
          "longitud double, timestamp timestamp_ntz")
P0, P1, P2 = (40.0, -3.0), (40.1, -3.0), (40.2, -3.0)
TS = dt.datetime(2024, 1, 10, 1, 0, 0)


def _row(plate, eid, uoid, rt, pos):
    return (plate, eid, uoid, f"2024-01-10 {rt}", pos[0], pos[1], TS)


def _edge(spark):
    state = spark.createDataFrame([
        _row("A", 1, "U0", "00:00:00", P0), _row("B", 2, "U0", "00:00:00", P0),
        _row("D", 3, "U0", "00:00:00", (None, None)), _row("E", 4, "U0", "00:00:00", P0)], SCHEMA)
    snaps = spark.createDataFrame([
        _row("A", 10, "U1", "03:00:00", P0), _row("C", 11, "U1", "03:00:00", P1),
        _row("D", 12, "U1", "03:00:00", (None, None)),
        _row("E", 13, "U1", "03:00:00", P1), _row("E", 14, "U1", "06:00:00", P2),
        _row("A", 20, "U2", "09:00:00", P1), _row("C", 21, "U2", "09:00:00", P2),
        _row("D", 22, "U2", "09:00:00", P1),
        _row("A", 30, "U3", "12:00:00", P1), _row("B", 31, "U3", "12:00:00", P0),
        _row("C", 32, "U3", "12:00:00", P2), _row("D", 33, "U3", "12:00:00", (None, None))], SCHEMA)
    return state, snaps


def test_fold_edge_rows(spark):
    state, snaps = _edge(spark)
    final = {r["matricula"]: r["event_id"] for r in ST.fold_state(state, snaps, FOLD_DAY).collect()}
    assert final == {"A": 20, "B": 2, "D": 33, "E": 13}
    moves = ST.movement_log(state, snaps, FOLD_DAY).groupBy("matricula").count().collect()
    assert {r[0]: r[1] for r in moves} == {"A": 1, "D": 2, "E": 1}


def test_fold_add_new_inserts(spark):
    state, snaps = _edge(spark)
    final = {r["matricula"]: r["event_id"] for r in
             ST.fold_state(state, snaps, FOLD_DAY, add_new=True).collect()}
    assert final["C"] == 21 and final["A"] == 20


def _loop_fold(state_rows, pos_rows, day):
    """The reference's loop, written plainly on the driver (test oracle only)."""
    state = {r["matricula"]: r for r in state_rows}
    day_rows = [r for r in pos_rows if r["timestamp"].date().isoformat() == day]
    entries = sorted({(r["realTime"], r["uoid"]) for r in day_rows})
    by_uoid = {}
    for r in pos_rows:
        by_uoid.setdefault(r["uoid"], []).append(r)
    moves = 0
    for _, u in entries:
        locs = {}
        for r in sorted(by_uoid[u], key=lambda r: (r["realTime"], r["event_id"]), reverse=True):
            locs[r["matricula"]] = r
        for plate, r in locs.items():
            if plate in state:
                old = state[plate]
                if not (r["latitud"] == old["latitud"] and r["longitud"] == old["longitud"]):
                    state[plate] = r
                    moves += 1
    return {k: v["event_id"] for k, v in state.items()}, moves


def test_fold_equals_loop(spark):
    pos = positions(spark, SF_SMALL)
    state = ST.initial_state(pos, STATE_CUTOFF)
    want, want_moves = _loop_fold(state.collect(), pos.collect(), FOLD_DAY)
    got = {r["matricula"]: r["event_id"] for r in ST.fold_state(state, pos, FOLD_DAY).collect()}
    assert got == want
    assert ST.movement_log(state, pos, FOLD_DAY).count() == want_moves == 26


def test_upsert_idempotent_and_unique(spark):
    pos = positions(spark, SF_SMALL)
    state = ST.initial_state(pos, STATE_CUTOFF)
    upd = S.dedupe_snapshots(S.snapshot_by_id(pos, "S00079011"))
    once = ST.upsert_state(state, upd)
    twice = ST.upsert_state(once, upd)
    assert once.count() == once.select("matricula").distinct().count() == 15
    key = ["matricula", "event_id"]
    assert sorted(map(tuple, once.select(*key).collect())) == sorted(map(tuple, twice.select(*key).collect()))


def test_dedupe_keep_first_and_last(spark):
    state, snaps = _edge(spark)
    first = S.dedupe_snapshots(snaps.where(F.col("matricula") == "E"), keep="first").first()
    last = S.dedupe_snapshots(snaps.where(F.col("matricula") == "E"), keep="last").first()
    assert (first["event_id"], last["event_id"]) == (13, 14)


def test_compare_with_state(spark):
    state, snaps = _edge(spark)
    got = S.compare_with_state(snaps.where(F.col("uoid") == "U3"), state)
    assert {r["matricula"]: r["movement"] for r in got.collect()} == {
        "A": "moved", "B": "same", "C": "new", "D": "same"}


def test_rows_without_a_plate_are_never_added(spark):
    state, snaps = _edge(spark)
    updates = spark.createDataFrame([_row(None, 50, "U9", "13:00:00", P1), _row("A", 51, "U9", "13:00:00", P2)], SCHEMA)
    once = ST.upsert_state(state, updates)
    twice = ST.upsert_state(once, updates)
    assert once.count() == twice.count() == 4 and once.where("matricula IS NULL").count() == 0
    assert ST.fold_state(state, snaps.unionByName(updates), FOLD_DAY, add_new=True).where("matricula IS NULL").count() == 0


def test_a_late_snapshot_does_not_overwrite(spark):
    from flotilla.session import fresh_path
    from flotilla.sources import state_store
    from flotilla.streaming import live_state
    state, snaps = _edge(spark)
    base, feed = fresh_path(spark, "late"), fresh_path(spark, "late-feed")
    live_state.write_initial_state(state, base)
    snaps.where("uoid <> 'U2'").coalesce(1).write.mode("append").parquet(feed)
    live_state.run_available(spark, feed, base, snaps.schema)
    before = sorted(map(tuple, state_store.read_version(spark, base).collect()), key=repr)
    state_store.write_version(state_store.read_version(spark, base), base, state_store.latest_version(spark, base) + 1, "snapshot:x")  # a job in between
    snaps.where("uoid = 'U2'").coalesce(1).write.mode("append").parquet(feed)  # older than U3
    live_state.run_available(spark, feed, base, snaps.schema)
    assert state_store.versions(spark, base) == [0, 1, 2, 3]
    assert sorted(map(tuple, state_store.read_version(spark, base).collect()), key=repr) == before
    late = live_state.late_rows(spark, base)  # kept for a correction, and counted
    assert sorted(r.event_id for r in late.collect()) == [20, 21, 22] and state_store.step_of(spark, base, 3)["late"] == 3
    assert {r.version for r in late.select(F.col("version").cast("int")).distinct().collect()} == {3}


# ------------------------------------------------------------- merge on read

def _rows(df):
    return sorted(map(tuple, df.select("matricula", "event_id", "uoid", "latitud", "longitud").collect()), key=repr)


def _store(spark, state, **kw):
    from flotilla.session import fresh_path
    from flotilla.sources import state_store
    base = fresh_path(spark, "merge")
    state_store.write_version(state, base, 0, **kw)
    return base


def test_an_upsert_writes_only_its_plates(spark):
    import os
    from flotilla.sources import state_store
    state = spark.range(20_000).selectExpr("concat('P', id) AS matricula", "id AS event_id", "'U0' AS uoid", "'2024-01-10' AS realTime",
                                           "rand(1) AS latitud", "rand(2) AS longitud", "timestamp_ntz'2024-01-10 01:00:00' AS timestamp")
    base = _store(spark, state)
    updates = spark.createDataFrame([_row("P7", 90_000, "U1", "03:00:00", P1), _row("new", 90_001, "U1", "03:00:00", P2), _row(None, 1, "U1", "03:00:00", P2)], SCHEMA)
    current = state_store.read_version(spark, base)
    state_store.write_delta(ST.upsert_delta(current, updates), base, 1, "s1")

    def size(folder):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))
    assert size(state_store.version_path(base, 1, delta=True)) < size(state_store.version_path(base, 0)) / 20
    assert _rows(state_store.read_version(spark, base)) == _rows(ST.upsert_state(state_store.read_version(spark, base, 0), updates))
    plan = state_store.read_version(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(matricula" not in plan          # the full table stays where it is
    some = state_store.read_version(spark, base, plates=["P7", "P8", "absent"])
    assert {r.matricula: r.event_id for r in some.collect()} == {"P7": 90_000, "P8": 8}
    assert "PartitionFilters: [plate_bucket" in some._jdf.queryExecution().executedPlan().toString()


def test_merge_on_read_equals_upserts_in_turn(spark, monkeypatch):
    from flotilla.sources import state_store
    monkeypatch.setattr(state_store, "MAX_DELTAS", 3)                                      # compacts on the way
    state, snaps = _edge(spark)
    base, plain = _store(spark, state), state
    for i in range(8):
        updates = S.dedupe_snapshots(snaps.where(F.col("uoid") == f"U{i % 3 + 1}")).withColumn("event_id", F.col("event_id") + 100 * i)
        add_new = i % 2 == 0
        source, target = state_store.begin_step(spark, base, f"s{i}")
        assert (source, target) == (i, i + 1)
        for _ in range(1 + i % 2):                                                         # a rerun writes the same version
            assert state_store.begin_step(spark, base, f"s{i}") == (source, target)
            state_store.write_delta(ST.upsert_delta(state_store.read_version(spark, base, source), updates, add_new=add_new), base, target, f"s{i}")
        plain = spark.createDataFrame(ST.upsert_state(plain, updates, add_new=add_new).collect(), SCHEMA)
        assert _rows(state_store.read_version(spark, base)) == _rows(plain)
    assert len(state_store._parts(spark, base, 8)[1]) <= 3
    before = {v: _rows(state_store.read_version(spark, base, v)) for v in (7, 8)}
    gone = state_store.expire(spark, base, keep=2)
    assert gone and {v: _rows(state_store.read_version(spark, base, v)) for v in (7, 8)} == before
    assert state_store.begin_step(spark, base, "s7") == (7, 8)
    import pytest
    with pytest.raises(ValueError, match="was built on it"):
        state_store.begin_step(spark, base, "s6")
    state_store.expire(spark, base, keep=1)
    if len(state_store.versions(spark, base)) == 1:
        with pytest.raises(ValueError, match="is gone"):
            state_store.begin_step(spark, base, "s7")


def test_a_stop_between_the_writes_of_a_version(spark, monkeypatch):
    """Wherever a writer stops, the step starts from the same version again."""
    import pytest
    from flotilla.sources import state_store
    state, snaps = _edge(spark)
    base = _store(spark, state)
    delta = S.dedupe_snapshots(snaps.where("uoid = 'U1'")).select(*state.columns)

    def stop(*a, **k):
        raise RuntimeError("stopped")
    for name in ("_write_delta", "_note"):
        for _ in range(2):                                                                 # first a new version, then a repeated one
            with monkeypatch.context() as m:
                m.setattr(state_store, name, stop)
                with pytest.raises(RuntimeError):
                    state_store.write_delta(delta, base, 1, "fold:a")
            assert state_store.begin_step(spark, base, "fold:a") == (0, 1)
            assert state_store.begin_step(spark, base, "fold:b") == (0, 1)
            state_store.write_delta(delta, base, 1, "fold:a")
            assert state_store.step_of(spark, base, 1)["step"] == "fold:a" and state_store.begin_step(spark, base, "fold:a") == (0, 1)
    with monkeypatch.context() as m:                                                       # another step after a stop takes its place
        m.setattr(state_store, "_write_delta", stop)
        with pytest.raises(RuntimeError):
            state_store.write_delta(delta, base, 2, "fold:b")
    state_store.write_delta(delta, base, 2, "fold:c")
    assert state_store.begin_step(spark, base, "fold:b") == (2, 3) and state_store.begin_step(spark, base, "fold:c") == (1, 2)


def test_empty_states_and_deltas(spark):
    from flotilla.sources import state_store
    state, snaps = _edge(spark)
    base = _store(spark, state.limit(0))
    assert state_store.read_version(spark, base).count() == 0
    state_store.write_delta(state.limit(0), base, 1, "none")
    state_store.write_delta(state, base, 2, "all")
    assert state_store.read_version(spark, base, 1).count() == 0 and state_store.read_version(spark, base).count() == 4
    assert state_store.read_version(spark, base).schema == state.schema
