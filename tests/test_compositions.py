"""Library paths not covered by the registered queries."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.operators import snapshots as S
from flotilla.operators import state as ST
from flotilla.plans.studies import fold_job, snapshot_job
from flotilla.session import fresh_path
from flotilla.sources import tables
from flotilla.sources.fixture import FOLD_DAY, SNAPSHOT_ID, STATE_CUTOFF, positions


def test_upsert_without_new_plates(spark):
    schema = "matricula string, event_id long, latitud double"
    state = spark.createDataFrame([("A", 1, 40.0), ("B", 2, 40.0)], schema)
    upd = spark.createDataFrame([("A", 10, 40.1), ("C", 11, 40.2)], schema)
    keep = {r[0]: r[1] for r in ST.upsert_state(state, upd, add_new=False).collect()}
    add = {r[0]: r[1] for r in ST.upsert_state(state, upd, add_new=True).collect()}
    assert keep == {"A": 10, "B": 2} and add == {"A": 10, "B": 2, "C": 11}


def test_write_json_shards(spark):
    p = positions(spark, SF_SMALL).select("event_id", "matricula")
    path = fresh_path(spark, "json-shards")
    tables.write_json(p, path, num_shards=3)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 3 and spark.read.json(path).count() == 1000


def test_chunk_rows_per_vehicle(spark):
    p = positions(spark, SF_SMALL).select("event_id", "idVehiculo", "epochTime")
    ch = tables.chunk_rows(p, 50, scope="vehicle")
    per = ch.groupBy("idVehiculo").agg(F.count(F.lit(1)).alias("n"), F.max("batch_id").alias("b")).collect()
    assert all(r["b"] == (r["n"] - 1) // 50 for r in per)


def test_snapshot_job(spark):
    pos = positions(spark, SF_SMALL)
    state = ST.initial_state(pos, STATE_CUTOFF)
    compared, new_state = snapshot_job(pos, state, SNAPSHOT_ID)
    assert compared.count() == 6
    assert {r[0] for r in compared.select("movement").distinct().collect()} == {"moved"}
    assert new_state.count() == 15 == new_state.select("matricula").distinct().count()
    moved = S.dedupe_snapshots(S.snapshot_by_id(pos, SNAPSHOT_ID)).select("event_id")
    assert moved.join(new_state, "event_id", "left_anti").count() == 0


def test_fold_job(spark):
    pos = positions(spark, SF_SMALL)
    final, moves = fold_job(pos, ST.initial_state(pos, STATE_CUTOFF), FOLD_DAY)
    assert final.count() == 15 and moves.count() == 26
