"""Command-line jobs: the reference's four workloads over a partitioned
positions table.

    python -m flotilla.plans.jobs trips    --positions P --out O [--start D --end D] [--state S]
    python -m flotilla.plans.jobs index    --positions P [--start D --end D]
    python -m flotilla.plans.jobs snapshot --positions P --state S --uoid U --out O
    python -m flotilla.plans.jobs fold     --positions P --state S --day D [--until D] --out O [--add-new]
    python -m flotilla.plans.jobs features --positions P --out O [--start D --end D]
    python -m flotilla.plans.jobs study    --features F --out O --model linear ...

On a cluster: ``spark-submit --py-files flotilla.zip flotilla/plans/jobs.py <job> ...``
with ``--input-bytes`` / ``--cores`` to size the partitions.

``--state`` is a folder with a versioned plate state
(:mod:`flotilla.sources.state_store`): the snapshot and fold jobs read its
newest version and write the rows they change as the next one, and a rerun repeats
its own step. The trips job keeps each vehicle's last seen row there (:mod:`flotilla.sources.last_seen`).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from flotilla.operators import features as FT
from flotilla.operators import models as M
from flotilla.operators import replay as R
from flotilla.operators import snapshots as S
from flotilla.operators import state as ST
from flotilla.operators.trips import extract_trips, last_rows, last_rows_before, trip_starts
from flotilla.plans.studies import demand_study, trip_job
from flotilla.session import cluster_settings, cut_lineage, get_session
from flotilla.sources import feature_store, last_seen, snapshot_index, state_store, tables


def _carry(spark: SparkSession, a) -> DataFrame | None:
    """The row of each vehicle before the range, by a scan of the positions before it."""
    if not a.start:
        return None
    before = (_dt.date.fromisoformat(a.start) - _dt.timedelta(days=1)).isoformat()
    return last_rows_before(tables.read_positions(spark, a.positions, None, before), a.start)


def run_trips(spark: SparkSession, a) -> dict:
    """Trips that end in the range. The row before the range of each vehicle comes
    from the last-seen table of the run before (``--state``: this run leaves its
    own there), or else from a scan of the positions before the range."""
    pos = tables.read_positions(spark, a.positions, a.start, a.end)
    metrics: dict = {}
    carry = None
    if a.start and a.pairing == "vehicle":
        if a.state:
            carry = last_seen.read(spark, a.state, (_dt.date.fromisoformat(a.start) - _dt.timedelta(days=1)).isoformat())
        else:
            carry = _carry(spark, a)
    trip_job(pos, a.out, pairing=a.pairing, compat=a.compat, metrics=metrics, carry_in=carry, audit=a.audit,
             dates=(a.start, a.end) if a.start and a.end else None, rejects_path=a.rejects or f"{a.out.rstrip('/')}-rejects")
    if a.state and a.end and a.pairing == "vehicle":
        seen = pos if carry is None else pos.unionByName(carry.select(*pos.columns))
        last_seen.write(last_rows(seen), a.state, a.end)
    return metrics


def _ingested(spark: SparkSession, a, day: str, until: str | None = None) -> DataFrame:
    """Positions ingested from ``day`` to ``until``, and ``--margin`` days around: a
    scan of these partitions only."""
    end = _dt.date.fromisoformat(until or day) + _dt.timedelta(days=a.margin)
    start = _dt.date.fromisoformat(day) - _dt.timedelta(days=a.margin)
    return tables.read_positions(spark, a.positions, start.isoformat(), end.isoformat())


def _index(spark: SparkSession, a) -> str | None:
    """The snapshot index beside the positions, if there is one."""
    path = a.index or f"{a.positions.rstrip('/')}-snapshots"
    return path if a.index or snapshot_index.exists(spark, path) else None


def run_index(spark: SparkSession, a) -> dict:
    path = a.index or f"{a.positions.rstrip('/')}-snapshots"
    snapshot_index.write_index(tables.read_positions(spark, a.positions, a.start, a.end), path)
    return {"index": path}


def run_snapshot(spark: SparkSession, a) -> dict:
    """One snapshot against the state. Its rows are found by ``--day``, else by the
    snapshot index, else by a scan that skips what the files' uoid ranges rule out."""
    index = _index(spark, a)
    if a.day:
        pos = _ingested(spark, a, a.day)
    elif index:
        pos = snapshot_index.read_snapshot(spark, a.positions, index, a.uoid)
    else:
        pos = tables.read_positions(spark, a.positions)
    step = f"snapshot:{a.uoid}"
    source, target = state_store.begin_step(spark, a.state, step)
    state = state_store.read_version(spark, a.state, source)
    snap = S.cast_numeric(S.snapshot_by_id(pos, a.uoid)).select(*state.columns)
    S.compare_with_state(snap, state).write.mode("overwrite").parquet(a.out)
    path = state_store.write_delta(ST.upsert_delta(state, S.dedupe_snapshots(snap, keep=a.keep)), a.state, target, step)
    return {"state_version": target, "state_path": path}


def run_fold(spark: SparkSession, a) -> dict:
    """The snapshots of a day, or of the days from ``--day`` to ``--until``, over the state."""
    index, until = _index(spark, a), a.until or a.day
    days = [(_dt.date.fromisoformat(a.day) + _dt.timedelta(days=i)).isoformat() for i in range((_dt.date.fromisoformat(until) - _dt.date.fromisoformat(a.day)).days + 1)]
    if index:  # every row of each uoid listed in those days, whenever it was ingested
        known = snapshot_index.read_index(spark, index)
        entries = reduce(DataFrame.unionByName, [snapshot_index.entries_of_day(known, d) for d in days])
        pos = snapshot_index.read_dates(spark, a.positions, snapshot_index.dates_of(known, entries))
    else:      # those ingested within the margin
        pos = _ingested(spark, a, a.day, until)
    step = f"fold:{a.day}" if until == a.day else f"fold:{a.day}..{until}"
    source, target = state_store.begin_step(spark, a.state, step)
    state = state_store.read_version(spark, a.state, source)
    pos = pos.select(*state.columns)
    if until == a.day:
        changes = cut_lineage(ST.changes(state, pos, a.day, add_new=a.add_new, observed_only=True), "fold-changes")  # once, for both results
        log, delta = ST.log_of(changes), ST.changed_rows(changes, state.columns)
    else:
        changes = cut_lineage(R.replay_changes(state, pos, a.day, until, add_new=a.add_new), "replay-changes")
        log, delta = R.replay_log(changes), R.replayed_rows(changes)
    log.write.mode("overwrite").parquet(a.out)
    path = state_store.write_delta(delta, a.state, target, step)
    return {"state_version": target, "state_path": path}


def run_features(spark: SparkSession, a) -> dict:
    """The view of the range; with ``--store`` the range's dates are added to the
    stored view (or replaced there), and the whole view is written out."""
    pos = tables.read_positions(spark, a.positions, a.start, a.end)
    if a.store:
        approximate = a.approx_rsd is not None
        trips = extract_trips(pos, compat=True, carry_in=_carry(spark, a), with_date=True)
        feature_store.write_increment(pos, trips, a.store, approximate=approximate)
        view = feature_store.read_view(spark, a.store, approximate)
    else:
        view = FT.cluster_hour_features(pos, trip_starts(pos, compat=True), approx_rsd=a.approx_rsd)
    view.write.mode("overwrite").parquet(a.out)
    return {}


def run_study(spark: SparkSession, a) -> dict:
    feats = spark.read.parquet(a.features)
    cols = M.MODEL_FEATURES if not a.no_availability else M.FEATURES_NO_AVAILABILITY
    out = demand_study(feats, a.vehicle_type, cols, a.label, a.model,
                       with_pct=not a.no_availability)
    out.write.mode("overwrite").parquet(a.out)
    return {}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="flotilla.plans.jobs")
    p.add_argument("--input-bytes", type=int, help="input size, sizes the partitions for a cluster")
    p.add_argument("--cores", type=int, help="total executor cores of the cluster")
    sub = p.add_subparsers(dest="job", required=True)

    t = sub.add_parser("trips")
    t.add_argument("--positions", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--start")
    t.add_argument("--end")
    t.add_argument("--state", help="folder of the last-seen rows used as carry-in")
    t.add_argument("--rejects", help="folder of trips that miss a REQUIRED column (default: <out>-rejects)")
    t.add_argument("--pairing", choices=["vehicle", "global"], default="vehicle")
    t.add_argument("--compat", action="store_true")
    t.add_argument("--audit", action="store_true")
    t.set_defaults(fn=run_trips)

    i = sub.add_parser("index")
    i.add_argument("--positions", required=True)
    i.add_argument("--index", help="folder of the snapshot index (default: <positions>-snapshots)")
    i.add_argument("--start")
    i.add_argument("--end")
    i.set_defaults(fn=run_index)

    s = sub.add_parser("snapshot")
    s.add_argument("--positions", required=True)
    s.add_argument("--state", required=True)
    s.add_argument("--uoid", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--day", help="ingestion day of the snapshot: prunes the scan")
    s.add_argument("--index", help="folder of the snapshot index (default: <positions>-snapshots, if it is there)")
    s.add_argument("--margin", type=int, default=1, help="days around --day that are read")
    s.add_argument("--keep", choices=["first", "last"], default="first")
    s.set_defaults(fn=run_snapshot)

    f = sub.add_parser("fold")
    f.add_argument("--positions", required=True)
    f.add_argument("--state", required=True)
    f.add_argument("--day", required=True)
    f.add_argument("--until", help="last day of a range that is replayed in one run")
    f.add_argument("--out", required=True)
    f.add_argument("--add-new", action="store_true")
    f.add_argument("--index", help="folder of the snapshot index (default: <positions>-snapshots, if it is there)")
    f.add_argument("--margin", type=int, default=1, help="days around --day that are read")
    f.set_defaults(fn=run_fold)

    e = sub.add_parser("features")
    e.add_argument("--positions", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--start")
    e.add_argument("--end")
    e.add_argument("--store", help="folder of the view by increments; with --approx-rsd it keeps sketches")
    e.add_argument("--approx-rsd", type=float, help="approximate numAvailable with this relative error")
    e.set_defaults(fn=run_features)

    m = sub.add_parser("study")
    m.add_argument("--features", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--vehicle-type", choices=FT.VEHICLE_TYPES)
    m.add_argument("--label", choices=["numTrips", "tripYesNo"], default="numTrips")
    m.add_argument("--model", choices=["tree", "tree_class", "linear", "ridge", "bagging", "exact_tree", "exact_tree_class", "exact_bagging"], default="linear")
    m.add_argument("--no-availability", action="store_true")
    m.set_defaults(fn=run_study)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    if spark is None:
        extra = cluster_settings(a.input_bytes, a.cores) if a.input_bytes and a.cores else None
        spark = get_session(app_name=f"flotilla-{a.job}", extra=extra)
    result = a.fn(spark, a)
    print(json.dumps({"job": a.job, **{k: v for k, v in result.items()}}, default=str))
    return result


if __name__ == "__main__":
    main()
