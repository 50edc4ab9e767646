"""Control counts of FIXTURES.md part 3 (sf0.001)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.operators import snapshots as S
from flotilla.operators.state import initial_state
from flotilla.plans.studies import features_from
from flotilla.sources.fixture import SNAPSHOT_ID, STATE_CUTOFF, positions


def test_fixture_table_facts(spark):
    p = positions(spark, SF_SMALL)
    r = p.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("idVehiculo").alias("vehicles"),
              F.countDistinct("uoid").alias("snapshots"),
              F.count(F.when(F.col("latitud").isNull(), 1)).alias("no_pos")).first()
    assert (r["rows"], r["vehicles"], r["snapshots"], r["no_pos"]) == (1000, 15, 120, 43)
    assert p.select("uoid", "realTime").distinct().count() == 236


def test_feature_view_counts(spark):
    f = features_from(spark, SF_SMALL)
    r = f.agg(F.count(F.lit(1)).alias("rows"),
              F.count(F.when(F.col("numTrips").isNull(), 1)).alias("trips_null"),
              F.count(F.when(F.col("numAvailable").isNull(), 1)).alias("avail_null"),
              F.max("numTrips").alias("max_trips"), F.max("numAvailable").alias("max_avail"),
              F.count(F.when(F.col("weekday") == "Thursday", 1)).alias("thursday")).first()
    assert tuple(r) == (980, 241, 0, 2, 2, 129)


def test_latest_snapshot_vs_state(spark):
    p = positions(spark, SF_SMALL)
    snap = S.snapshot_by_id(p, SNAPSHOT_ID)
    assert snap.count() == 6 and snap.select("matricula").distinct().count() == 5
    cmp = S.compare_with_state(S.dedupe_snapshots(snap), initial_state(p, STATE_CUTOFF))
    assert {r[0]: r[1] for r in cmp.groupBy("movement").count().collect()} == {"moved": 5}
