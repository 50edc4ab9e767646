"""Spark session and shared-folder helpers.

The library never hard-codes a machine-local scratch path for cluster runs:
anything that must be written (lineage cuts, round-trip sinks, streaming
checkpoints) goes below the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (unit tests, a
laptop) do we create one under the system temp folder and register it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "flotilla", extra: dict[str, str] | None = None) -> SparkSession:
    """Builder with the settings every job here relies on.

    AQE re-plans joins and coalesces shuffle partitions at runtime, the skew
    join split is on, and the UI server stays off. ``extra`` takes e.g.
    :func:`cluster_settings` for a cluster run.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Partition sizing for a cluster run.

    Scan splits of ``target_partition_bytes``; the initial shuffle
    partition count is large enough that each holds about that much of the
    input (the position table is the largest shuffled input; its rows keep
    their size through pairing), at least 3 waves of the cluster's cores.
    AQE then coalesces small partitions to the same advisory size and splits
    skewed join partitions. E.g. 100 TB on 1000 x 16 cores -> 256 MB splits,
    about 410k shuffle partitions.
    """
    shuffle = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Exchange files that outlive a lost executor are served by the
        # external shuffle service / decommissioning on the cluster.
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
    }


_FALLBACK_DIR: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` of the session,
    else the context's checkpoint folder.

    When neither is set, a local master (tests, a laptop) gets a fresh folder,
    made once per process and registered as the context's checkpoint folder (the config
    key itself cannot be changed on a running session); on a cluster, where a
    local folder would scatter the data, that is an error.
    """
    global _FALLBACK_DIR
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if path:
        return path
    try:
        ctx_dir = spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - Spark Connect has no context
        ctx_dir = None
    if _FALLBACK_DIR and ctx_dir and _FALLBACK_DIR in ctx_dir:
        return _FALLBACK_DIR
    if ctx_dir:
        return ctx_dir
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    _FALLBACK_DIR = tempfile.mkdtemp(prefix="flotilla-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(_FALLBACK_DIR)
    except Exception:  # pragma: no cover
        pass
    return _FALLBACK_DIR


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused location below the shared folder (one per call)."""
    base = shared_dir(spark)
    return os.path.join(base, "flotilla", f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Cut the lineage: write ``df`` as a Parquet table in a new location below
    the shared folder and read it back. One job computes ``df`` once (an
    eager ``checkpoint()`` computes it twice: once to count, once to save);
    the table survives executor loss and later stages start from it."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
