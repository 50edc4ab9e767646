"""Snapshots: one ``uoid`` = one poll of the whole fleet.

Listing, picking, counting, de-duplicating and comparing snapshots with the
keyed vehicle state. All joins with the state are plain equi-joins: AQE
measures the state at runtime and broadcasts it only when it is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``, otherwise it stays a
shuffle join (skew-split by AQE).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flotilla.schema import NUMERIC_TO_DOUBLE

PLATE = "matricula"


def day_filter(day: str, ts: str = "timestamp") -> Column:
    """``DATE(ts) = day`` in range form, so it prunes and pushes down."""
    nxt = (_dt.date.fromisoformat(day) + _dt.timedelta(days=1)).isoformat()
    c = F.col(ts)
    return (c >= F.lit(day).cast("timestamp_ntz")) & (c < F.lit(nxt).cast("timestamp_ntz"))


def snapshot_by_id(positions: DataFrame, uoid: str) -> DataFrame:
    """All rows of one snapshot (bound literal, pushed to the scan)."""
    return positions.where(F.col("uoid") == F.lit(uoid))


def cast_numeric(df: DataFrame, cols=NUMERIC_TO_DOUBLE) -> DataFrame:
    """NUMERIC -> double for the columns present; NULL stays NULL."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols if c in df.columns})


def snapshot_list(positions: DataFrame, day: str | None = None) -> DataFrame:
    """Distinct (uoid, realTime) of a day: one entry per snapshot part."""
    p = positions.where(day_filter(day)) if day else positions
    return p.select("uoid", "realTime").distinct()


def snapshot_list_first_n(positions: DataFrame, day: str, n: int) -> DataFrame:
    """The first ``n`` list entries by (realTime, uoid) -- a top-n, by design."""
    return snapshot_list(positions, day).orderBy("realTime", "uoid").limit(n)


def nth_snapshot(positions: DataFrame, day: str, n: int) -> DataFrame:
    """Entry ``n`` of the day (the reference takes the last of the first four)."""
    first = snapshot_list_first_n(positions, day, n)
    key = F.struct("realTime", "uoid")
    return first.agg(F.max_by("uoid", key).alias("uoid"), F.max("realTime").alias("realTime"))


def latest_snapshot_id(positions: DataFrame) -> DataFrame:
    """uoid of the newest row (``ORDER BY epochTime DESC LIMIT 1``) as a
    partial aggregate; ties go to the greater uoid."""
    key = F.struct("epochTime", "uoid")
    return positions.agg(F.max_by("uoid", key).alias("uoid"), F.max("epochTime").alias("epochTime"))


def dedupe_snapshots(rows: DataFrame, keep: str = "first",
                     keys=("uoid", PLATE), order=("realTime", "event_id")) -> DataFrame:
    """One row per (uoid, plate).

    keep='first' keeps the smallest realTime (the reference fills a dict in
    realTime DESC order, so the last write -- the oldest row -- wins; equal
    times by the row id, where there is one);
    keep='last' keeps the newest. An aggregate rather than a window: the
    partial aggregation collapses a hot (uoid, plate) group before the
    shuffle.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    cols = rows.columns
    row = F.struct(*[F.col(c) for c in cols])
    ok = F.struct(*[F.col(c) for c in order if c in cols])
    pick = F.min_by(row, ok) if keep == "first" else F.max_by(row, ok)
    return rows.groupBy(*keys).agg(pick.alias("_r")).select("_r.*")


def compare_with_state(snapshot: DataFrame, state: DataFrame, plate: str = PLATE) -> DataFrame:
    """Every snapshot row plus ``movement``: new / same / moved.

    Absence is tested on a marker column (a state position may be NULL);
    positions compare null-safely, like Python's ``None == None``.
    """
    st = state.select(F.col(plate), F.lit(True).alias("_known"),
                      F.col("latitud").alias("_old_lat"), F.col("longitud").alias("_old_lon"))
    j = snapshot.join(st, plate, "left")
    same = F.col("latitud").eqNullSafe(F.col("_old_lat")) & F.col("longitud").eqNullSafe(F.col("_old_lon"))
    mv = F.when(F.col("_known").isNull(), "new").when(same, "same").otherwise("moved")
    return j.withColumn("movement", mv).drop("_known", "_old_lat", "_old_lon")


def new_vehicles(snapshot: DataFrame, state: DataFrame, plate: str = PLATE) -> DataFrame:
    """Snapshot rows whose plate the state does not know."""
    return snapshot.join(state.select(plate), plate, "left_anti")
