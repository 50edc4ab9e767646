"""Live vehicle state: snapshots arriving as files, folded per micro-batch.

The reference replays snapshots by hand in a driver loop. Here new snapshot
files are a Structured Streaming file source and ``foreachBatch`` folds each
micro-batch into the state with the closed form of
:func:`flotilla.operators.state.fold_state` (add_new=True: a new plate is
inserted at its first sighting).

The fold is associative over consecutive chunks of snapshots (the state
keeps the last accepted position), so it does not matter how the arriving
files are grouped into micro-batches, as long as every snapshot arrives
whole and after the previous one.

State versions: a batch reads the newest version and writes what it changes as
the next one, under the step (query, batch), so a retried batch recomputes the
same version and the batch jobs may write versions in between. A version also
notes the newest snapshot entry folded so far: a file that arrives late can't
overwrite what came after it. Its rows aren't lost: they go to the folder
``late`` (a table by version), and the version notes how many. The query's
checkpoint (in the shared folder) records which files were consumed.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flotilla.operators.state import changed_rows, changes
from flotilla.session import cut_lineage
from flotilla.sources.state_store import begin_step, latest_version, read_version, step_of, write_delta, write_version


def write_initial_state(state: DataFrame, base: str) -> None:
    write_version(state, base, 0)


def late_path(base: str, version: int) -> str:
    return os.path.join(base, "late", f"version={version:010d}")


def _fold_batch(base: str, plate: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        step = f"live:{query}:{batch_id}"
        source, target = begin_step(spark, base, step)
        prev = read_version(spark, base, source)
        through = step_of(spark, base, source).get("through")
        entry = F.struct(F.col("realTime").alias("rt"), F.col("uoid").alias("u"))
        rows, late = batch.select(*prev.columns), 0
        if through:
            done = F.coalesce(entry <= F.struct(F.lit(through[0]).alias("rt"), F.lit(through[1]).alias("u")), F.lit(False))
            rows = cut_lineage(rows.withColumn("_late", done), "live-batch")  # read twice, so computed once
            late = rows.where("_late").count()
            if late:
                rows.where("_late").drop("_late").write.mode("overwrite").parquet(late_path(base, target))
            rows = rows.where("NOT _late").drop("_late")
        newest = rows.agg(F.max(entry).alias("e")).first().e
        ch = cut_lineage(changes(prev, rows, day=None, add_new=True, plate=plate, observed_only=True), "live-changes")
        write_delta(changed_rows(ch, prev.columns, plate), base, target, step, plate=plate,
                    through=[newest.rt, newest.u] if newest else through, late=late)
    return run


def late_rows(spark: SparkSession, base: str) -> DataFrame | None:
    """Rows of snapshots that came after newer ones, with the version whose batch
    brought them; None if there were none."""
    folder = os.path.join(base, "late")
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    exists = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root)
    return spark.read.parquet(folder) if exists else None


def run_available(spark: SparkSession, feed_path: str, base: str, schema,
                  plate: str = "matricula") -> int:
    """Process every snapshot file not yet consumed (trigger availableNow)
    and return the number of the newest state version."""
    stream = spark.readStream.schema(schema).parquet(feed_path)
    q = (stream.writeStream
         .foreachBatch(_fold_batch(base, plate))
         .option("checkpointLocation", os.path.join(base, "checkpoint"))
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return latest_version(spark, base)


def read_state(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    return read_version(spark, base, version)
