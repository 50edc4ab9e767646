"""Replay of many days' snapshots over the state, as an associative scan.

:func:`flotilla.operators.state.fold_state` replays one day; days follow each
other, but a day's work needs of the days before only one thing per plate: where
the plate was last seen. So the observations of a plate are cut into segments, one
a day, and every segment is folded on its own to (first, last, changes inside).
The segments' last positions, a row per plate and day, are then carried to the
next segment, where only the first observation has to be compared. A plate that
is in every poll of the range is never one window, and no day waits for another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flotilla.operators.snapshots import PLATE, dedupe_snapshots
from flotilla.operators.state import MAX_BROADCAST_ENTRIES
from flotilla.session import cut_lineage

_POS = ("latitud", "longitud")


def _entries(positions: DataFrame, start: str, end: str) -> DataFrame:
    """(day, uoid, entry_rt): the list entries of each day of the range."""
    day = F.to_date("timestamp")
    return (positions.where((F.col("timestamp") >= F.lit(start).cast("timestamp_ntz")) & (day <= F.lit(end).cast("date")))
            .select(day.alias("_day"), "uoid", F.col("realTime").alias("_rt")).distinct())


def _same(a: str, b: str) -> Column:
    out = F.lit(True)
    for c in _POS:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def replay_changes(state: DataFrame, positions: DataFrame, start: str, end: str, add_new: bool = False,
                   keep: str = "first", plate: str = PLATE) -> DataFrame:
    """Accepted changes of the days ``start`` to ``end`` (inclusive): ``_row`` (the
    state's columns), ``_seq`` (day, entry time, uoid), ``_old`` (the position
    before; NULL where a new plate is inserted) and ``_new``.

    Equal to folding day after day: entries of a day in (realTime, uoid) order, each
    with all rows of its uoid, the first per plate (``keep``). Rows without a plate
    move nothing; without ``add_new`` plates the state doesn't know are left out.
    """
    entries = cut_lineage(_entries(positions, start, end), "replay-entries")
    ids = entries.select("uoid").distinct()
    if entries.count() <= MAX_BROADCAST_ENTRIES:  # a few a poll; more are joined by shuffle
        entries, ids = F.broadcast(entries), F.broadcast(ids)
    snap = dedupe_snapshots(positions.where(F.col(plate).isNotNull()).join(ids, "uoid", "left_semi"), keep=keep)
    if not add_new:
        snap = snap.join(state.select(plate), plate, "left_semi")
    seq = F.struct(F.col("_day").alias("day"), F.col("_rt").alias("rt"), F.col("uoid").alias("u"))
    obs = snap.join(entries, "uoid").select(F.col(plate).alias("_plate"), "_day", seq.alias("_seq"),
                                            F.struct(*[F.col(c) for c in state.columns]).alias("_row"), F.struct(*_POS).alias("_at"))
    w = Window.partitionBy("_plate", "_day").orderBy("_seq")
    parts = cut_lineage(obs.withColumn("_before", F.lag("_at").over(w)), "replay-segments")
    # A row per plate and day: where the segment ends, and where the plate was before it.
    ends = parts.groupBy("_plate", "_day").agg(F.max_by("_at", "_seq").alias("_end"), F.min("_seq").alias("_seq"))
    known = state.select(F.col(plate).alias("_plate"), F.struct(*_POS).alias("_stored"))
    carried = (ends.withColumn("_carry", F.lag("_end").over(Window.partitionBy("_plate").orderBy("_day")))
               .join(known, "_plate", "left").select("_plate", "_day", "_seq", F.coalesce("_carry", "_stored").alias("_carry")))
    heads = parts.where(F.col("_before").isNull()).join(carried, ["_plate", "_day", "_seq"]).withColumn("_old", F.col("_carry"))
    rest = parts.where(F.col("_before").isNotNull()).withColumn("_old", F.col("_before"))
    moved = heads.drop("_carry").unionByName(rest).where(F.col("_old").isNull() | ~_same("_at", "_old"))
    return moved.select("_plate", "_row", "_seq", "_old", F.col("_at").alias("_new"))


def replayed_rows(changes: DataFrame) -> DataFrame:
    """The last accepted row of each changed plate: the delta of the state."""
    return changes.groupBy("_plate").agg(F.max_by("_row", "_seq").alias("r")).select("r.*")


def replay_state(state: DataFrame, positions: DataFrame, start: str, end: str, add_new: bool = False,
                 keep: str = "first", plate: str = PLATE) -> DataFrame:
    """The state after the range."""
    delta = replayed_rows(replay_changes(state, positions, start, end, add_new, keep, plate))
    delta = cut_lineage(delta, "replayed")
    return state.join(delta.select(plate), plate, "left_anti").select(*state.columns).unionByName(delta)


def replay_log(changes: DataFrame, plate: str = PLATE) -> DataFrame:
    """Every accepted position change, with its day (insertions aren't moves)."""
    row_id = [F.col("_row.event_id")] if "event_id" in changes.schema["_row"].dataType.names else []
    return changes.where(F.col("_old").isNotNull()).select(
        F.col("_plate").alias(plate), F.col("_seq.day").alias("day"), F.col("_seq.u").alias("entry_uoid"), F.col("_seq.rt").alias("entry_realTime"), *row_id,
        F.col("_old.latitud").alias("old_latitud"), F.col("_old.longitud").alias("old_longitud"),
        F.col("_new.latitud").alias("new_latitud"), F.col("_new.longitud").alias("new_longitud"))
