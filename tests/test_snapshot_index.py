"""Data skipping on the snapshot id."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.operators import snapshots as S
from flotilla.operators.state import initial_state
from flotilla.plans import jobs
from flotilla.session import fresh_path
from flotilla.sources import snapshot_index, state_store, tables
from flotilla.sources.fixture import FOLD_DAY, SNAPSHOT_ID, STATE_CUTOFF, positions


def _stored(spark, **options):
    path = fresh_path(spark, "indexed")
    tables.write_positions(positions(spark, SF_SMALL), path, options=options)
    snapshot_index.write_index(tables.read_positions(spark, path), f"{path}-snapshots")
    return path, f"{path}-snapshots"


def _scan(df):
    """(rows, files) that the scan of an executed plan read."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return [leaf.metrics().apply(m).value() for m in ("numOutputRows", "numFiles")]


def test_one_snapshot_reads_its_date_and_its_pages(spark):
    path, index = _stored(spark, **{"parquet.block.row.count.limit": "4", "parquet.block.size.row.check.min": "1"})
    whole = tables.read_positions(spark, path)
    uoid = whole.groupBy("uoid").count().orderBy(F.desc("count")).first()
    df = snapshot_index.read_snapshot(spark, path, index, uoid.uoid)
    rows, files = _scan(df)
    dates = whole.where(F.col("uoid") == uoid.uoid).select("ingest_date").distinct().count()
    day_rows = whole.where(F.col("ingest_date") == df.first().ingest_date).count()
    assert df.count() == uoid["count"] and files <= 2 * dates
    assert uoid["count"] <= rows <= uoid["count"] + 8 < day_rows
    # Without the index the dates' row groups are still skipped by their uoid.
    rows, _ = _scan(S.snapshot_by_id(whole, uoid.uoid))
    assert rows <= uoid["count"] + 8


def test_bloom_filter_rules_out_absent_ids(spark):
    path, _ = _stored(spark)
    inside = tables.read_positions(spark, path).agg(F.min("uoid"), F.max("uoid")).first()
    absent = inside[0] + "x"
    assert inside[0] < absent < inside[1]
    rows, _ = _scan(S.snapshot_by_id(tables.read_positions(spark, path), absent))
    assert rows == 0


def test_index_is_kept_by_date(spark):
    path, index = _stored(spark)
    before = sorted(map(tuple, snapshot_index.read_index(spark, index).collect()), key=repr)
    snapshot_index.write_index(tables.read_positions(spark, path, "2024-01-05", "2024-01-08"), index)
    assert sorted(map(tuple, snapshot_index.read_index(spark, index).collect()), key=repr) == before
    by_scan = S.snapshot_list(tables.read_positions(spark, path), FOLD_DAY)
    by_index = snapshot_index.entries_of_day(snapshot_index.read_index(spark, index), FOLD_DAY)
    assert sorted(map(tuple, by_index.collect())) == sorted(map(tuple, by_scan.select("uoid", "realTime").collect())) != []
    assert snapshot_index.read_snapshot(spark, path, index, "nowhere").count() == 0


def test_jobs_find_a_snapshot_without_its_day(spark):
    path = fresh_path(spark, "jobs-index")
    tables.write_positions(positions(spark, SF_SMALL), path)
    results = []
    for with_index in (False, True):
        if with_index:
            jobs.main(["index", "--positions", path], spark=spark)
        state = fresh_path(spark, "jobs-index-state")
        state_store.write_version(initial_state(tables.read_positions(spark, path), STATE_CUTOFF), state, 0)
        moves, log = fresh_path(spark, "moves"), fresh_path(spark, "log")
        jobs.main(["snapshot", "--positions", path, "--state", state, "--uoid", SNAPSHOT_ID, "--out", moves], spark=spark)
        jobs.main(["fold", "--positions", path, "--state", state, "--day", FOLD_DAY, "--out", log], spark=spark)
        results.append([sorted(map(tuple, df.collect()), key=repr) for df in
                        (spark.read.parquet(moves).select("event_id", "movement"), spark.read.parquet(log), state_store.read_version(spark, state))])
    assert results[0] == results[1] and all(results[0])
