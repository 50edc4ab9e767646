"""Keyed vehicle state: build, upsert, and the sequential fold in closed form.

The reference keeps one document per plate and replays snapshots in a
driver loop. Here the state is a table with one row per plate:

* ``upsert_state`` = updates UNION (state anti-join updates) -- a
  whole-row overwrite by key, written to a *new* location (never the path
  being read).
* ``fold_state`` replays every snapshot of a day without a loop. After each
  snapshot a known plate's stored position equals its latest observed
  position (equal -> kept, different -> replaced), so "differs from the
  state" is "differs from the previous observation": a ``lag`` per plate.
  A plate has at most (snapshots of the day + 1) observations, so the
  per-plate window is bounded whatever the table size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flotilla.operators.snapshots import PLATE, dedupe_snapshots, snapshot_list
from flotilla.session import cut_lineage

_SEQ = "_seq"
# Entries (two short strings each) that are broadcast; more are joined by shuffle.
MAX_BROADCAST_ENTRIES = 100_000


def initial_state(positions: DataFrame, cutoff: str, plate: str = PLATE) -> DataFrame:
    """Last row per plate among rows ingested on or before ``cutoff``
    (newest epochTime, then realTime and uoid; ties to the smaller row id, where
    there is one). Rows without a plate can't be keyed and are left out."""
    rows = positions.where((F.col("ingest_date") <= F.lit(cutoff).cast("date")) & F.col(plate).isNotNull())
    row = F.struct(*[F.col(c) for c in rows.columns])
    newest = F.struct(*[F.col(c) for c in ("epochTime", "realTime", "uoid") if c in rows.columns],
                      *[(-F.col("event_id")).alias("tie")] if "event_id" in rows.columns else [])
    return rows.groupBy(plate).agg(F.max_by(row, newest).alias("_r")).select("_r.*")


def upsert_state(state: DataFrame, updates: DataFrame, plate: str = PLATE,
                 add_new: bool = True) -> DataFrame:
    """Whole-row overwrite by plate. ``updates`` must be unique per plate
    (see :func:`dedupe_snapshots`). add_new=False only replaces known plates.
    Updates without a plate have no key: they are rejected (left out), so a
    rerun never adds them again."""
    upd = upsert_delta(state, updates, plate, add_new)
    return upd.unionByName(state.join(upd.select(plate), plate, "left_anti"))


def _observations(positions: DataFrame, day: str, keep: str) -> DataFrame:
    """One row per (list entry, plate): each (uoid, realTime) entry of the day
    carries the de-duplicated rows of its whole uoid, like the reference's
    per-entry query; ordered by ``_seq`` = (1, entry realTime, uoid)."""
    # A row per poll of the day: written once, used by both joins, and broadcast
    # after its size is checked (a shuffle on a few ids would be a few tasks).
    entries = cut_lineage(snapshot_list(positions, day).select("uoid", F.col("realTime").alias("_entry_rt")), "entries")
    ids = entries.select("uoid").distinct()
    if entries.count() <= MAX_BROADCAST_ENTRIES:
        entries, ids = F.broadcast(entries), F.broadcast(ids)
    # Rows without a plate can't move anything.
    rows = positions.where(F.col(PLATE).isNotNull()).join(ids, "uoid", "left_semi")
    snap = dedupe_snapshots(rows, keep=keep)
    obs = snap.join(entries, "uoid")
    return obs.withColumn(_SEQ, F.struct(F.lit(1).alias("k"), F.col("_entry_rt").alias("rt"),
                                         F.col("uoid").alias("u"))).drop("_entry_rt")


def changes(state: DataFrame, positions: DataFrame, day: str | None, add_new: bool = False,
            keep: str = "first", plate: str = PLATE, observed_only: bool = False) -> DataFrame:
    """State rows and accepted changes, one window pass per plate.

    The state is referenced once: whether a plate is known comes from the
    same per-plate window (is there a seq-0 row?) instead of a second join.
    With ``observed_only`` the state rows of plates without an observation are left
    out (a semi join), so only what the snapshots touch is sorted.
    """
    cols = state.columns
    obs = _observations(positions, day, keep).select(*cols, _SEQ)
    if observed_only:
        obs = cut_lineage(obs, "observations")
        state = state.join(obs.select(plate).distinct(), plate, "left_semi").select(*cols)
    init = state.withColumn(_SEQ, F.struct(F.lit(0).alias("k"), F.lit(None).cast("string").alias("rt"),
                                           F.lit(None).cast("string").alias("u")))
    w = Window.partitionBy(plate).orderBy(_SEQ)
    u = (init.unionByName(obs)
         .withColumn("_old_lat", F.lag("latitud").over(w))
         .withColumn("_old_lon", F.lag("longitud").over(w))
         .withColumn("_first", F.row_number().over(w) == 1))
    if not add_new:
        # The first row of a known plate is its state row (seq 0 sorts first).
        u = u.withColumn("_known", F.first(F.col(f"{_SEQ}.k") == 0).over(w)).where(F.col("_known"))
    same = F.col("latitud").eqNullSafe(F.col("_old_lat")) & F.col("longitud").eqNullSafe(F.col("_old_lon"))
    return u.where(F.col("_first") | ~same)


def fold_state(state: DataFrame, positions: DataFrame, day: str, add_new: bool = False,
               keep: str = "first", plate: str = PLATE) -> DataFrame:
    """State after replaying every snapshot of ``day`` in (realTime, uoid) order.

    add_new=False (the fold script): unknown plates are ignored.
    add_new=True: a plate's first sighting inserts it.
    """
    return state_of(changes(state, positions, day, add_new, keep, plate), state.columns, plate)


def state_of(ch: DataFrame, columns: list[str], plate: str = PLATE) -> DataFrame:
    """The state after the accepted changes."""
    row = F.struct(*[F.col(c) for c in columns])
    return ch.groupBy(plate).agg(F.max_by(row, F.col(_SEQ)).alias("_r")).select("_r.*")


def changed_rows(ch: DataFrame, columns: list[str], plate: str = PLATE) -> DataFrame:
    """The rows of :func:`state_of` that aren't the state's own: a delta of it."""
    return state_of(ch.where(F.col(f"{_SEQ}.k") == 1), columns, plate)


def upsert_delta(state: DataFrame, updates: DataFrame, plate: str = PLATE, add_new: bool = True) -> DataFrame:
    """The rows that :func:`upsert_state` writes: the updates with a plate (a known
    one, without ``add_new``). The state's other rows aren't touched."""
    upd = updates.select(*state.columns).where(F.col(plate).isNotNull())
    return upd if add_new else upd.join(state.select(plate), plate, "left_semi").select(*state.columns)


def movement_log(state: DataFrame, positions: DataFrame, day: str, add_new: bool = False,
                 keep: str = "first", plate: str = PLATE) -> DataFrame:
    """Every accepted position change: old and new position, snapshot entry."""
    return log_of(changes(state, positions, day, add_new, keep, plate), plate)


def log_of(ch: DataFrame, plate: str = PLATE) -> DataFrame:
    """The accepted changes as a log."""
    return ch.where(~F.col("_first")).select(
        plate, F.col(f"{_SEQ}.u").alias("entry_uoid"), F.col(f"{_SEQ}.rt").alias("entry_realTime"),
        *[c for c in ("event_id",) if c in ch.columns], F.col("_old_lat").alias("old_latitud"), F.col("_old_lon").alias("old_longitud"),
        F.col("latitud").alias("new_latitud"), F.col("longitud").alias("new_longitud"))
