"""Sources and sinks: partitioned Parquet tables, JSON lines, legacy text,
REQUIRED-field enforcement and batch numbering for keyed writers.

Writers that replace a table write to a fresh location and never overwrite
the path they read from; trips use dynamic partition overwrite so a rerun of
a date range replaces those dates instead of appending duplicates.
"""

from __future__ import annotations

import datetime as _dt
import json as _json
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flotilla.operators.pairs import DEFAULT_ORDER, row_numbers
from flotilla.schema import POSITION_REQUIRED, POSITION_SCHEMA, TRIP_REQUIRED
from flotilla.session import fresh_path
from flotilla.sources import pyrepr

JSON_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# ---------------------------------------------------------------- positions

#: Column by which the files of a date are sorted and Bloom-filtered.
SKIP_COLUMN = "uoid"


def write_positions(df: DataFrame, path: str, mode: str = "append",
                    rejects_path: str | None = None, options: dict[str, str] | None = None) -> None:
    """Position rows partitioned by ingestion date (the snapshot copy sink). Files
    are sorted by ``uoid`` and carry a Bloom filter of it, so a scan for one snapshot
    skips the row groups and pages of the others.
    With ``rejects_path``, rows missing a REQUIRED column go there instead, in
    the same mode (an append run twice repeats both). ``options`` go to the writer."""
    if rejects_path:
        df, bad = split_required(df, [c for c in POSITION_REQUIRED if c in df.columns])
        bad.write.mode(mode).parquet(rejects_path)
    # REBALANCE by the partition column: AQE groups a date's rows into
    # advisory-size partitions (a hot date is split, small ones merged), so
    # each date gets a few large files instead of one file per task.
    out = df.hint("rebalance", "ingest_date")
    skip = {f"parquet.bloom.filter.enabled#{SKIP_COLUMN}": "true", f"parquet.bloom.filter.adaptive.enabled#{SKIP_COLUMN}": "true"} if SKIP_COLUMN in df.columns else {}
    if skip:
        out = out.sortWithinPartitions("ingest_date", SKIP_COLUMN)
    out.write.mode(mode).options(**skip, **(options or {})).partitionBy("ingest_date").parquet(path)


def read_positions(spark: SparkSession, path: str, start: str | None = None,
                   end: str | None = None, schema: T.StructType = POSITION_SCHEMA) -> DataFrame:
    """Scan with the declared types; an inclusive ingestion-date range prunes
    partitions. NUMERIC columns at rest (decimals) are cast once here, a column
    the table lacks is NULL."""
    df = spark.read.parquet(path)
    df = df.select(*[(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                     for f in schema.fields])
    if start is not None:
        df = df.where(F.col("ingest_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("ingest_date") <= F.lit(end).cast("date"))
    return df


# -------------------------------------------------------------------- trips

def processed_at() -> Column:
    """Processing time as HH:mm:ss (the reference's print_time), an audit column."""
    return F.date_format(F.current_timestamp(), "HH:mm:ss")


def write_trips(trips: DataFrame, path: str, rerun_safe: bool = True, audit: bool = False,
                rejects_path: str | None = None, dates: tuple[str, str] | None = None) -> None:
    """Trips partitioned by end date: ``trip_date``, the ingestion date of the end
    row where the trips have it, else the date of ``timestamp_end``.

    A run over a range of dates owns exactly the trips that end in it: a trip
    that began earlier (its start row was carried in) belongs to the run of its
    end date, so no run touches another's partitions.

    rerun_safe=True: the dates present in ``trips`` are replaced, other dates
    stay. With ``dates`` (inclusive start and end) every date of that range is
    replaced, those without trips too: their old rows are removed first, and
    trips that end outside the range are an error. False: plain append (the
    reference, which duplicates rows when a range is processed twice).
    audit=True adds ``processed_at``. With ``rejects_path``, trips missing a
    REQUIRED column go there instead of the table, by the same dates.

    The trips are computed once: where both tables or the dates ask for several
    jobs, those start from a copy written to the shared folder.
    """
    out = trips if "trip_date" in trips.columns else trips.withColumn("trip_date", F.to_date("timestamp_end"))
    if dates:
        outside = ~F.col("trip_date").between(F.lit(dates[0]).cast("date"), F.lit(dates[1]).cast("date"))
        out = out.where(F.when(outside, F.raise_error(F.lit("a trip ends outside the range"))).otherwise(F.lit(True)))
    if audit:
        out = out.withColumn("processed_at", processed_at())
    parts, staged = [(out, path)], None
    if rejects_path or (dates and rerun_safe):
        staged = fresh_path(trips.sparkSession, "trips")
        out.write.parquet(staged)
        out = trips.sparkSession.read.parquet(staged)
        parts = [(out, path)]
    if rejects_path:
        good, bad = split_required(out, [c for c in TRIP_REQUIRED if c in trips.columns])
        parts = [(good, path), (bad, rejects_path)]
    for df, target in parts:
        w = df.hint("rebalance", "trip_date").write.partitionBy("trip_date")  # a few large files per date (see write_positions)
        if not rerun_safe:
            w.mode("append").parquet(target)
            continue
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(target)
        if dates:
            _drop_other_dates(trips.sparkSession, df, target, dates)
    if staged:
        _delete(trips.sparkSession, staged)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _drop_other_dates(spark: SparkSession, written: DataFrame, path: str, dates: tuple[str, str]) -> None:
    """Remove the partitions of the range's dates that got no rows (at most one per day)."""
    have = {str(r[0]) for r in written.select("trip_date").distinct().collect()}
    day, end = _dt.date.fromisoformat(dates[0]), _dt.date.fromisoformat(dates[1])
    while day <= end:
        if day.isoformat() not in have:
            _delete(spark, f"{path.rstrip('/')}/trip_date={day.isoformat()}")
        day += _dt.timedelta(days=1)


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --------------------------------------------------------------- JSON lines

def to_json_ready(df: DataFrame) -> DataFrame:
    """Timestamps as strings (the reference's ``str(timestamp)`` step)."""
    conv = {f.name: F.date_format(F.col(f.name), JSON_TS_FORMAT)
            for f in df.schema.fields
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    return df.withColumns(conv)


def write_json(df: DataFrame, path: str, num_shards: int | None = None) -> None:
    """JSON lines. ``num_shards`` fixes the file count (the reference writes
    one shard; that funnels the data through one task, so use it for small
    outputs only). Default: one file per partition."""
    out = to_json_ready(df)
    if num_shards:
        out = out.repartition(num_shards)
    out.write.mode("errorifexists").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


# -------------------------------------------------------------- legacy text

def write_legacy_text(df: DataFrame, path: str) -> None:
    """Rows as Python dict reprs, one per line (the reference's text hand-over)."""
    parts = []
    for i, f in enumerate(df.schema.fields):
        parts += [F.lit(("" if i == 0 else ", ") + f"{f.name!r}: "), pyrepr.literal(F.col(f"`{f.name}`"), f.dataType)]
    df.select(F.concat(F.lit("{"), *parts, F.lit("}")).alias("value")).write.text(path)


def read_legacy_text(spark: SparkSession, path: str, schema: T.StructType, corrupt: str | None = None) -> DataFrame:
    """Flat Python dict reprs (what ``repr`` writes, one or several on a line) with
    the columns of ``schema``; see :mod:`flotilla.sources.pyrepr`. Braces, quotes of
    both styles, escapes and the words None, True and False inside strings are
    text. Blank lines and separators are passed over.

    A record that isn't whole (cut off, nested, a value of another type) fails the
    read, as the reference does; with ``corrupt`` it is kept as a row whose raw
    text is in that column and whose other columns are NULL."""
    pieces = spark.read.text(path).select(F.explode(pyrepr.pieces(F.col("value"))).alias("_raw"))
    rows = pyrepr.parse(pieces, "_raw", schema, "r", "_whole")
    if corrupt:
        names = [F.when(F.col("_whole"), F.col("r")[f.name]).alias(f.name) for f in schema.fields]
        return rows.select(*names, F.when(~F.col("_whole"), F.col("_raw")).alias(corrupt))
    error = F.raise_error(F.concat(F.lit("not a record: "), F.col("_raw"))).cast(rows.schema["r"].dataType)
    checked = rows.withColumn("r", F.when(F.col("_whole"), F.col("r")).otherwise(error))
    return checked.select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])


# ---------------------------------------------------------- REQUIRED fields

def required_ok(cols: Iterable[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def split_required(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): Spark does not enforce ``nullable=False`` on write."""
    ok = required_ok(cols)
    return df.where(ok), df.where(~ok)


# ------------------------------------------------------------ write batches

def chunk_rows(df: DataFrame, size: int, entity: str = "idVehiculo",
               order: Sequence[str] = DEFAULT_ORDER, scope: str = "global") -> DataFrame:
    """``batch_id`` = (row number - 1) div ``size`` in a total order, computed
    distributed (see :func:`flotilla.operators.pairs.row_numbers`)."""
    n = row_numbers(df, entity=entity, order=order, scope=scope, out="_rn")
    return n.withColumn("batch_id", F.expr(f"(_rn - 1) div {int(size)}")).drop("_rn")


def write_keyed_batches(df: DataFrame, key: str, write_batch: Callable[[list], None],
                        batch_size: int = 400) -> None:
    """Send rows to an external keyed store in batches of ``batch_size`` per
    task (``foreachPartition``). ``write_batch`` receives a list of
    (key, row-dict) pairs. A row without a key gets a digest of its values, the
    same in every attempt, so a retried task overwrites what it wrote before
    (equal rows without a key are one document). Every row is written,
    including the last partial batch."""
    def run(rows):
        import hashlib
        buf = []
        for r in rows:
            d = r.asDict(recursive=True)
            buf.append((d.get(key) or hashlib.sha1(_json.dumps(d, sort_keys=True, default=str).encode()).hexdigest(), d))
            if len(buf) >= batch_size:
                write_batch(buf)
                buf = []
        if buf:
            write_batch(buf)
    df.foreachPartition(run)
