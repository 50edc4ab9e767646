"""Replay of a range of days against folding day after day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.operators import replay as R
from flotilla.operators import state as ST
from flotilla.plans import jobs
from flotilla.session import cut_lineage, fresh_path
from flotilla.sources import state_store, tables
from flotilla.sources.fixture import STATE_CUTOFF, positions

DAYS = ["2024-01-06", "2024-01-07", "2024-01-08", "2024-01-09"]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("add_new", [False, True])
def test_equals_day_after_day(spark, add_new):
    pos = cut_lineage(positions(spark, SF_SMALL))
    start = cut_lineage(ST.initial_state(pos, STATE_CUTOFF).where("right(matricula, 1) <> '3'"))
    state, log = start, []
    for day in DAYS:
        log += [(r.matricula, str(day), *r[1:]) for r in ST.movement_log(state, pos, day, add_new=add_new).collect()]
        state = cut_lineage(ST.fold_state(state, pos, day, add_new=add_new))
    cols = start.columns
    assert _rows(R.replay_state(start, pos, DAYS[0], DAYS[-1], add_new=add_new).select(*cols)) == _rows(state.select(*cols))
    got = R.replay_log(R.replay_changes(start, pos, DAYS[0], DAYS[-1], add_new=add_new)).collect()
    assert sorted(((r.matricula, str(r.day), *r[2:]) for r in got), key=repr) == sorted(log, key=repr) != []


def _edge(spark, rows):
    ts = {d: dt.datetime(2024, 1, int(d[-2:]), 1) for d in DAYS}
    return spark.createDataFrame([(p, i, u, f"{d} {rt}", None if at is None else float(at), 0.0, ts[d]) for i, (p, u, d, rt, at) in enumerate(rows)],
                                 "matricula string, event_id long, uoid string, realTime string, latitud double, longitud double, timestamp timestamp_ntz")


def test_edges(spark):
    """Null positions, days without a plate, a snapshot listed on two days, plates without a name."""
    a, b, c, d = DAYS
    rows = [("A", "1", a, "01", 1), ("A", "2", a, "02", 1), ("A", "3", c, "01", 2), ("A", "4", c, "02", 1), ("A", "5", d, "01", 1), ("B", "1", a, "01", None), ("B", "3", c, "01", None),
            ("B", "4", c, "02", 5), ("N", "2", a, "02", 7), ("N", "5", d, "01", 7), (None, "1", a, "01", 3), ("A", "6", a, "23", 9), ("A", "6", b, "00", 9), ("C", "6", b, "00", 4)]
    pos, state = _edge(spark, rows), _edge(spark, [("A", "0", a, "00", 1), ("B", "0", a, "00", None), ("C", "0", a, "00", 4)])
    for add_new in (False, True):
        plain = state
        for day in DAYS:
            plain = spark.createDataFrame(ST.fold_state(plain, pos, day, add_new=add_new).collect(), state.schema)
        assert _rows(R.replay_state(state, pos, a, d, add_new=add_new)) == _rows(plain)
    assert R.replay_changes(state, pos.limit(0), a, d).count() == 0 and _rows(R.replay_state(state.limit(0), pos, a, d)) == []


def test_a_plate_with_most_rows_spreads(spark):
    """One plate in every poll: no window holds more than its day, and segments lie in many partitions."""
    polls = spark.range(8000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('P', id) END AS matricula", "id AS event_id", "concat('U', id) AS uoid",
                                         "date_format(timestampadd(MINUTE, id * 5, timestamp'2024-01-06'), 'yyyy-MM-dd HH:mm:ss') AS realTime",
                                         "CAST(id % 7 AS double) AS latitud", "0.0D AS longitud", "CAST(timestampadd(MINUTE, id * 5, timestamp'2024-01-06') AS timestamp_ntz) AS timestamp")
    state = polls.where("matricula = 'hot' AND event_id = 0")
    ch = cut_lineage(R.replay_changes(state, polls, "2024-01-06", "2024-02-28", add_new=True))
    assert ch.where("_plate = 'hot'").count() == 8000 // 3 + 1 - 1  # every third poll moves it, the first is where it stood
    per_day = ch.where("_plate = 'hot'").groupBy("_seq.day").count().agg(F.max("count"), F.count("*")).first()
    assert per_day[0] <= 96 and per_day[1] >= 27


def test_job_over_a_range(spark):
    path = fresh_path(spark, "replay-positions")
    tables.write_positions(positions(spark, SF_SMALL), path)
    states = []
    for runs in ([(d, None) for d in DAYS], [(DAYS[0], DAYS[-1])]):
        base = fresh_path(spark, "replay-state")
        state_store.write_version(ST.initial_state(tables.read_positions(spark, path), STATE_CUTOFF), base, 0)
        for day, until in runs:
            for _ in range(1 if until is None else 2):  # repeated: the same version again
                jobs.main(["fold", "--positions", path, "--state", base, "--day", day, *(["--until", until] if until else []), "--out", fresh_path(spark, "log")], spark=spark)
        assert state_store.latest_version(spark, base) == len(runs)
        states.append(_rows(state_store.read_version(spark, base)))
    assert states[0] == states[1]
