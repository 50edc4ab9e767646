"""Index of snapshots: which ingestion dates hold the rows of a ``uoid``.

One row per (ingest_date, uoid, realTime) with the number of rows: a few rows a
poll, whatever the fleet's size. It is kept by date, so a run over a range of
dates replaces exactly those dates' entries. A snapshot, or all snapshots of a
day, is then read from the dates that hold it, and within their files from the
row groups and pages whose ``uoid`` range (the files are sorted by it) and Bloom
filter admit it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flotilla.operators.snapshots import day_filter
from flotilla.sources.tables import read_positions

COLUMNS = ["uoid", "realTime", "first_time", "last_time", "rows", "ingest_date"]


def index_of(positions: DataFrame) -> DataFrame:
    """The index entries of position rows (partially aggregated: one exchange of few rows)."""
    return positions.where(F.col("uoid").isNotNull()).groupBy("uoid", "realTime", "ingest_date").agg(
        F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"), F.count(F.lit(1)).alias("rows")).select(*COLUMNS)


def write_index(positions: DataFrame, path: str) -> None:
    """Index the dates present in ``positions``; other dates' entries stay."""
    (index_of(positions).hint("rebalance", "ingest_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ingest_date").parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def entries_of_day(index: DataFrame, day: str) -> DataFrame:
    """(uoid, realTime) entries with a row of ``day``, as
    :func:`flotilla.operators.snapshots.snapshot_list` finds them by a scan. An entry
    whose rows begin before the day and end after it is listed too."""
    spans = (F.col("last_time") >= F.lit(day).cast("timestamp_ntz")) & (F.col("first_time") < F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz"))
    touched = day_filter(day, "first_time") | day_filter(day, "last_time") | spans
    return index.where(touched).select("uoid", "realTime").distinct()


def dates_of(index: DataFrame, uoids: DataFrame) -> list[str]:
    """Ingestion dates that hold rows of the snapshots (at most the table's dates)."""
    found = index.join(uoids.select("uoid").distinct(), "uoid", "left_semi").select("ingest_date").distinct()
    return sorted(str(r[0]) for r in found.collect())


def read_dates(spark: SparkSession, positions_path: str, dates: list[str]) -> DataFrame:
    """Positions of these ingestion dates alone (partition pruning)."""
    return read_positions(spark, positions_path).where(F.col("ingest_date").isin([F.lit(d).cast("date") for d in dates]))


def read_snapshot(spark: SparkSession, positions_path: str, index_path: str, uoid: str) -> DataFrame:
    """All rows of one snapshot, without knowing its day."""
    index = read_index(spark, index_path)
    dates = dates_of(index, index.where(F.col("uoid") == F.lit(uoid)))
    return read_dates(spark, positions_path, dates).where(F.col("uoid") == F.lit(uoid))
