"""Command-line jobs over a partitioned positions table and a versioned state."""

import pytest

from conftest import SF_SMALL
from flotilla.operators.state import initial_state
from flotilla.plans import jobs
from flotilla.session import fresh_path
from flotilla.operators.trips import extract_trips
from flotilla.sources import last_seen, state_store, tables
from flotilla.sources.fixture import FOLD_DAY, SNAPSHOT_ID, STATE_CUTOFF, positions


@pytest.fixture(scope="module")
def warehouse(spark):
    pos_path = fresh_path(spark, "jobs-positions")
    tables.write_positions(positions(spark, SF_SMALL), pos_path)
    state = fresh_path(spark, "jobs-state")
    state_store.write_version(initial_state(tables.read_positions(spark, pos_path), STATE_CUTOFF), state, 0)
    return pos_path, state


def test_trip_job(spark, warehouse):
    pos, _ = warehouse
    out = fresh_path(spark, "jobs-trips")
    m = jobs.main(["trips", "--positions", pos, "--out", out], spark=spark)
    assert m["trips"] == 702 and spark.read.parquet(out).count() == 702


def test_snapshot_then_fold_jobs(spark, warehouse):
    pos, state = warehouse
    r = jobs.main(["snapshot", "--positions", pos, "--state", state, "--uoid", SNAPSHOT_ID,
                   "--out", fresh_path(spark, "jobs-moves")], spark=spark)
    assert r["state_version"] == 1
    assert state_store.read_version(spark, state).count() == 15
    moves = fresh_path(spark, "jobs-fold")
    r = jobs.main(["fold", "--positions", pos, "--state", state, "--day", FOLD_DAY, "--out", moves],
                  spark=spark)
    assert r["state_version"] == 2 and state_store.versions(spark, state) == [0, 1, 2]
    assert spark.read.parquet(moves).count() > 0


def test_features_and_study_jobs(spark, warehouse):
    pos, _ = warehouse
    feats = fresh_path(spark, "jobs-features")
    jobs.main(["features", "--positions", pos, "--out", feats], spark=spark)
    assert spark.read.parquet(feats).count() == 980
    out = fresh_path(spark, "jobs-study")
    jobs.main(["study", "--features", feats, "--out", out, "--model", "bagging",
               "--label", "tripYesNo"], spark=spark)
    assert spark.read.parquet(out).count() > 0


def _trips(df):
    return sorted(map(tuple, df.select("idVehiculo", "epochTime_start", "epochTime_end").collect()))


@pytest.mark.parametrize("with_state", [True, False])
def test_two_ranges_into_one_folder_equal_one_run(spark, warehouse, with_state):
    pos, _ = warehouse
    out, state = fresh_path(spark, "jobs-trips-two"), fresh_path(spark, "jobs-seen")
    more = ["--state", state] if with_state else []
    run = lambda a, b: jobs.main(["trips", "--positions", pos, "--out", out, "--start", a, "--end", b, *more], spark=spark)
    if with_state:
        last_seen.write(tables.read_positions(spark, pos).limit(0), state, "2023-12-31")
        with pytest.raises(FileNotFoundError):  # a day is missing in between
            run("2024-01-10", "2024-01-12")
    run("2024-01-01", "2024-01-09")
    run("2024-01-10", "2024-01-12")
    run("2024-01-10", "2024-01-12")
    whole = fresh_path(spark, "jobs-trips-one")
    jobs.main(["trips", "--positions", pos, "--out", whole, "--start", "2024-01-01", "--end", "2024-01-12"], spark=spark)
    assert _trips(spark.read.parquet(out)) == _trips(spark.read.parquet(whole)) != []


def test_a_date_without_trips_loses_its_old_rows(spark):
    out = fresh_path(spark, "trips-empty-date")
    trips = extract_trips(positions(spark, SF_SMALL, "2024-01-05", "2024-01-08"), with_date=True)
    tables.write_trips(trips, out, dates=("2024-01-05", "2024-01-08"))
    assert {str(r[0]) for r in spark.read.parquet(out).select("trip_date").distinct().collect()} >= {"2024-01-06", "2024-01-07"}
    fewer = trips.where("trip_date <> DATE '2024-01-07'")
    tables.write_trips(fewer, out, dates=("2024-01-05", "2024-01-08"))
    assert _trips(spark.read.parquet(out)) == _trips(fewer)
    with pytest.raises(Exception, match="outside the range"):
        tables.write_trips(trips, out, dates=("2024-01-05", "2024-01-06"))


def test_rerunning_a_step_gives_the_same_log_and_state(spark, warehouse):
    pos, _ = warehouse
    state = fresh_path(spark, "jobs-rerun")
    state_store.write_version(initial_state(tables.read_positions(spark, pos), STATE_CUTOFF), state, 0)
    runs = []
    for _ in range(2):
        out = fresh_path(spark, "jobs-log")
        r = jobs.main(["fold", "--positions", pos, "--state", state, "--day", FOLD_DAY, "--out", out], spark=spark)
        runs.append((r["state_version"], sorted(map(tuple, spark.read.parquet(out).collect()), key=repr),
                     sorted(map(tuple, state_store.read_version(spark, state).collect()), key=repr)))
    assert runs[0] == runs[1] and runs[0][0] == 1 and runs[0][1]
    jobs.main(["snapshot", "--positions", pos, "--state", state, "--uoid", SNAPSHOT_ID, "--day", FOLD_DAY, "--out", fresh_path(spark, "m")], spark=spark)
    with pytest.raises(ValueError, match="built on it"):
        jobs.main(["fold", "--positions", pos, "--state", state, "--day", FOLD_DAY, "--out", fresh_path(spark, "m")], spark=spark)


def test_fold_reads_only_its_days(spark, warehouse):
    pos, _ = warehouse
    args = type("A", (), {"positions": pos, "margin": 1})
    plan = jobs._ingested(spark, args, FOLD_DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
