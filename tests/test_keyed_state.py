"""The stream's own state per plate."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.operators import snapshots as S
from flotilla.operators import state as ST
from flotilla.plans.q_snapshots import state_of
from flotilla.session import fresh_path
from flotilla.sources.fixture import FOLD_DAY, positions
from flotilla.streaming import keyed_state as K
from test_state import _edge

COLS = ["matricula", "event_id", "latitud", "longitud"]


def _rows(df):
    return sorted(map(tuple, df.select(*COLS).collect()), key=repr)


def test_in_order_equals_the_fold(spark):
    """Two drops of files; the second in several micro-batches, with rows repeated and one without a plate."""
    pos, state = positions(spark, SF_SMALL), state_of(spark, SF_SMALL)
    day = pos.where(S.day_filter(FOLD_DAY))
    base, feed = fresh_path(spark, "keyed-state"), fresh_path(spark, "keyed-feed")
    noon = F.lit(f"{FOLD_DAY} 12:00:00")
    drops = [[day.where(F.col("realTime") < noon)], [day.where((F.col("realTime") >= noon) & (F.col("uoid") == u))
             for u in sorted(r[0] for r in day.where(F.col("realTime") >= noon).select("uoid").distinct().collect())]]
    for files in drops:
        for f in files:
            f = f.unionByName(f).unionByName(f.limit(1).withColumn("matricula", F.lit(None).cast("string")))
            f.coalesce(1).write.mode("append").parquet(feed)
        K.run_available(spark, feed, base, pos.schema, state, max_files=1)
    K.run_available(spark, feed, base, pos.schema, state)                       # nothing new
    assert _rows(K.current_state(spark, base, pos.schema, state)) == _rows(ST.fold_state(state, pos, FOLD_DAY, add_new=True))
    assert K.read_log(spark, base, pos.schema, "late").count() == 0


def test_late_rows_are_listed_and_change_nothing(spark):
    state, snaps = _edge(spark)
    base, feed = fresh_path(spark, "keyed-state"), fresh_path(spark, "keyed-feed")
    snaps.where("uoid <> 'U2'").coalesce(1).write.mode("append").parquet(feed)
    K.run_available(spark, feed, base, snaps.schema, state)
    before = {r.matricula: (r.latitud, r.longitud) for r in K.current_state(spark, base, snaps.schema, state).collect()}
    newer = {r[0] for r in snaps.where("uoid = 'U3'").select("matricula").collect()}
    snaps.where("uoid = 'U2'").coalesce(1).write.mode("append").parquet(feed)
    K.run_available(spark, feed, base, snaps.schema, state)
    after = {r.matricula: (r.latitud, r.longitud) for r in K.current_state(spark, base, snaps.schema, state).collect()}
    late = {r.matricula for r in K.read_log(spark, base, snaps.schema, "late").collect()}
    assert late == {r[0] for r in snaps.where("uoid = 'U2'").select("matricula").collect()} & newer and late
    assert all(after[p] == before[p] for p in late)
