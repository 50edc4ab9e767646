"""Positions stored by vehicle, so that pairing needs no exchange.

The table is bucketed by vehicle (and partitioned by ingestion date): each bucket
is read by one task, in which the vehicle's window runs at once; a shuffle is paid
when a date is written, not whenever its trips are computed. A task must not
get a vehicle with most of the rows that way, so these are kept apart:

    <path>/cold   bucketed; vehicles of at most ``hot_rows`` rows
    <path>/hot    plain; vehicles with more, and rows without a vehicle
    <path>/hot-vehicles   their names, a table that only grows
    <path>/layout         number of buckets and schema

A vehicle that becomes hot leaves its earlier rows in ``cold``; reading takes them
from there by a plain scan, in which a bucket is split like any file. Hot rows are paired
in ranges (:mod:`flotilla.operators.pairs`), with exchanges of these rows only.

Writing a date replaces it, so a run that broke off is repeated. One writer at a time.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flotilla.operators.pairs import DEFAULT_HOT_ROWS, DEFAULT_ORDER, attach_previous, order_in, previous_in_groups
from flotilla.session import cut_lineage
from flotilla.sources import files

ENTITY, PART = "idVehiculo", "ingest_date"
BUCKETS = 64


def _layout(spark: SparkSession, path: str) -> tuple[int, StructType]:
    row = spark.read.schema("buckets int, columns string").json(os.path.join(path, "layout")).first()
    return row.buckets, StructType.fromJson(json.loads(row.columns))


def _table(spark: SparkSession, path: str) -> str:
    """Name of the bucketed table in this session's catalog, as the folder now is."""
    buckets, schema = _layout(spark, path)
    name = "positions_" + hashlib.sha1(path.encode()).hexdigest()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{c}`" for c in [ENTITY, *[c for c in DEFAULT_ORDER if c in schema.names]])
    location = os.path.join(path, "cold").replace("'", "\\'")
    files.make_folder(spark, os.path.join(path, "cold"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{PART}`) CLUSTERED BY (`{ENTITY}`) "
              f"SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{location}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def _hot_vehicles(spark: SparkSession, path: str) -> DataFrame:
    folder = os.path.join(path, "hot-vehicles")
    if not files.names(spark, folder):
        return spark.createDataFrame([], f"{ENTITY} string")
    return spark.read.schema(f"{ENTITY} string").parquet(folder).distinct()


def write_bucketed(positions: DataFrame, path: str, buckets: int = BUCKETS, hot_rows: int = DEFAULT_HOT_ROWS) -> None:
    """Store positions by vehicle in place of what is stored of their dates.

    ``buckets`` is fixed by the first write: about the table's later size over what a
    task sorts well. Whether a vehicle is hot is decided by its rows in the whole
    table, these included."""
    spark = positions.sparkSession
    if not files.names(spark, os.path.join(path, "layout")):
        columns = StructType([f for f in positions.schema if f.name != PART] + [positions.schema[PART]])
        spark.createDataFrame([(buckets, columns.json())], "buckets int, columns string").coalesce(1).write.mode("overwrite").json(os.path.join(path, "layout"))
    buckets, schema = _layout(spark, path)
    positions = cut_lineage(positions.select(*schema.names), "to-bucket")  # read for its dates, counts and both tables
    dates = [r[0] for r in positions.select(PART).distinct().collect()]
    for d in dates:
        for part in ("cold", "hot"):
            files.delete(spark, os.path.join(path, part, f"{PART}={'__HIVE_DEFAULT_PARTITION__' if d is None else d}"))
    name = _table(spark, path)
    counts = spark.table(name).select(ENTITY).unionByName(positions.select(ENTITY)).where(F.col(ENTITY).isNotNull()).groupBy(ENTITY).count()
    known = _hot_vehicles(spark, path)
    fresh = cut_lineage(counts.where(F.col("count") > hot_rows).select(ENTITY).join(known, ENTITY, "left_anti"), "newly-hot")
    if not fresh.isEmpty():
        fresh.write.mode("append").parquet(os.path.join(path, "hot-vehicles"))
    hot = _hot_vehicles(spark, path)
    missing = positions.where(F.col(ENTITY).isNull())
    (positions.join(hot, ENTITY, "left_semi").select(*schema.names).unionByName(missing).hint("rebalance", PART)
     .write.mode("append").partitionBy(PART).parquet(os.path.join(path, "hot")))
    cold = positions.where(F.col(ENTITY).isNotNull()).join(hot, ENTITY, "left_anti").select(*schema.names)
    cold.repartition(buckets, ENTITY).write.mode("append").insertInto(name)


def _plain(spark: SparkSession, path: str, part: str, schema: StructType) -> DataFrame:
    folder = os.path.join(path, part)
    if not any(n.startswith(PART) for n in files.names(spark, folder)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """All stored positions."""
    _, schema = _layout(spark, path)
    return _plain(spark, path, "cold", schema).unionByName(_plain(spark, path, "hot", schema))


def previous_stored(spark: SparkSession, path: str, columns: Sequence[str] | None = None, prev_col: str = "prev",
                    start: str | None = None, end: str | None = None, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """:func:`flotilla.operators.pairs.attach_previous` of the stored positions (of an
    inclusive range of ingestion dates): per vehicle, without an exchange of the cold ones."""
    _, schema = _layout(spark, path)
    columns = list(columns or schema.names)

    def narrow(df: DataFrame) -> DataFrame:
        if start is not None:
            df = df.where(F.col(PART) >= F.lit(start).cast("date"))
        if end is not None:
            df = df.where(F.col(PART) <= F.lit(end).cast("date"))
        return df.select(*columns)

    cold, apart = narrow(spark.table(_table(spark, path))), narrow(_plain(spark, path, "hot", schema))
    hot = _hot_vehicles(spark, path)
    if not hot.isEmpty():
        earlier = narrow(_plain(spark, path, "cold", schema)).join(hot, ENTITY, "left_semi").select(*columns)
        cold, apart = cold.join(hot, ENTITY, "left_anti").select(*columns), apart.unionByName(earlier)
    paired = previous_in_groups(cold, ENTITY, order_in(cold), prev_col)
    if apart.isEmpty():
        return paired
    return paired.unionByName(attach_previous(apart, ENTITY, prev_col=prev_col, hot_rows=hot_rows))
