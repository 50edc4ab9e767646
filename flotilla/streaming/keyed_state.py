"""Live vehicle state kept per plate by the stream itself.

:mod:`flotilla.streaming.live_state` folds each micro-batch into a stored table by
joins. Here the last position of a plate is a value in Spark's state store
(``transformWithState``): a micro-batch touches the plates it brings and nothing else.
What comes out is a log, appended to Parquet once per batch (the file sink keeps
its own commits):

* ``change``: a plate's position differs from its last one (or the plate is new);
  the row, and the position before;
* ``late``: the row's snapshot isn't newer than the newest that the plate was seen
  in. The state doesn't go back; the row is kept here for a correction.

The first state comes from a table. :func:`current_state` is that table with each
plate's newest change in place.

Per micro-batch a plate's task keeps one row per snapshot, however often rows
repeat, so its memory follows the snapshots that arrive together (``max_files``), and not
a plate's number of rows. A snapshot part in which a plate has no row of its own isn't seen for
it. Rows without a plate have no state and are left out. Positions compare null-safely; a plate's
equal entries go by (realTime, uoid), null first, and of a snapshot's rows that with
the smallest (realTime, event_id) counts.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "latitud double, longitud double, realTime string, uoid string"


def _order(*values) -> tuple:
    """Values in an order with null first."""
    return tuple((v is not None, v if v is not None else 0) for v in values)


class LastPosition(StatefulProcessor):
    """Fold of one plate's observations."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", STATE)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        # No snapshot was folded yet: none is late.
        self.last.update((initialState.latitud, initialState.longitud, None, None))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.last.exists()
        lat, lon, *seen = self.last.get() if known else (None, None, None, None)
        through = _order(*seen)
        first: dict[str, Row] = {}
        entries = set()
        for r in rows:
            if seen[1] is not None and _order(r.realTime, r.uoid) <= through:
                yield self._out("late", r, None, None)
                continue
            entries.add((r.realTime, r.uoid))
            old = first.get(r.uoid)
            if old is None or _order(r.realTime, r.event_id) < _order(old.realTime, old.event_id):
                first[r.uoid] = r
        for real_time, uoid in sorted(entries, key=lambda e: _order(*e)):
            r = first[uoid]
            if not known or (r.latitud, r.longitud) != (lat, lon):
                yield self._out("change", r, lat, lon)
                known, lat, lon = True, r.latitud, r.longitud
            seen = [real_time, uoid]
        if entries:
            self.last.update((lat, lon, *seen))

    def _out(self, kind: str, r: Row, lat, lon) -> Row:
        return Row(kind=kind, old_latitud=lat, old_longitud=lon, **{c: r[c] for c in self.columns})

    def close(self) -> None:
        pass


def _log_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("kind", T.StringType()), T.StructField("old_latitud", T.DoubleType()),
                         T.StructField("old_longitud", T.DoubleType()), *schema.fields])


def log_path(base: str) -> str:
    return os.path.join(base, "log")


def run_available(spark: SparkSession, feed_path: str, base: str, schema: T.StructType, state: DataFrame,
                  plate: str = "matricula", max_files: int | None = None) -> None:
    """Fold every snapshot file not yet consumed (trigger availableNow), at most
    ``max_files`` a micro-batch. ``state`` is the first state; a query that has begun keeps its own."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(feed_path).where(F.col(plate).isNotNull())
    start = state.where(F.col(plate).isNotNull()).select(plate, "latitud", "longitud").groupBy(plate)
    log = rows.groupBy(plate).transformWithState(LastPosition(schema.names), _log_schema(schema), outputMode="append",
                                                 timeMode="none", initialState=start)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)  # the query copies the session's settings when it starts
    try:
        q = (log.writeStream.format("parquet").outputMode("append").option("path", log_path(base))
             .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(availableNow=True).start())
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
    q.awaitTermination()


def read_log(spark: SparkSession, base: str, schema: T.StructType, kind: str) -> DataFrame:
    """Rows of the log: ``change`` or ``late``."""
    return spark.read.schema(_log_schema(schema)).parquet(log_path(base)).where(F.col("kind") == F.lit(kind)).drop("kind")


def current_state(spark: SparkSession, base: str, schema: T.StructType, state: DataFrame, plate: str = "matricula") -> DataFrame:
    """The first state with each plate's newest change: one row per plate, in the columns of ``state``."""
    row = F.struct(*state.columns)
    changed = read_log(spark, base, schema, "change").groupBy(plate).agg(F.max_by(row, F.struct("realTime", "uoid")).alias("r")).select("r.*")
    return state.join(changed.select(plate), plate, "left_anti").select(*state.columns).unionByName(changed)
