"""Positions derived from the driver's ``events`` table.

``events`` (event_id, ts, user_id, event_type, value, props) becomes one
position row per event: the user is the vehicle, ``ts`` the poll time,
``value`` drives latitude and cluster. The derivation is pure Column
expressions, so Catalyst prunes the six source columns and pushes a time
range straight into the parquet scan.

The same derivation is kept as DuckDB SQL next to it (``DUCKDB_POSITIONS``)
so every oracle query starts from identical rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixture parameters that exist at every scale.
FOLD_DAY = "2024-01-10"
SNAPSHOT_ID = "S00079011"
RANGE_START = "2024-01-05"
RANGE_END = "2024-01-20"
STATE_CUTOFF = "2024-01-05"
SNAPSHOT_SECONDS = 21600          # one uoid per 6 hours
LAT_BASE, LAT_STEP = 4.04e1, 1e-2  # one latitude step = 1.11 km
LON_BASE, LON_JITTER = -3.7e0, 3e-4

# Whole seconds since 1970 of a timestamp without zone (independent of the
# session time zone, unlike unix_timestamp).
_EPOCH_SQL = "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def _no_position(e: DataFrame) -> Column:
    return (F.col("event_type") == "error") & (F.col("event_id") % 5 == 0)


def positions_from_events(events: DataFrame) -> DataFrame:
    """Column-only derivation of the positions table (FIXTURES.md section 2)."""
    lat_raw = F.lit(LAT_BASE) + F.floor(F.col("value") / F.lit(2.5e1)) * F.lit(LAT_STEP)
    lon_raw = F.lit(LON_BASE) + (F.col("event_id") % 4) * F.lit(LON_JITTER)
    missing = _no_position(events)
    epoch = F.expr(_EPOCH_SQL)
    cluster = (F.floor(F.col("value") / F.lit(2.5e1)).cast("int") % 8).cast("bigint")
    uid = F.col("user_id").cast("string")
    return events.select(
        F.col("event_id"),
        F.concat(F.lit("svc"), (F.col("user_id") % 4).cast("string")).alias("servicio"),
        F.concat(F.lit("V"), F.lpad(uid, 6, "0")).alias("idVehiculo"),
        F.concat(F.lit("M"), F.lpad(uid, 6, "0")).alias("matricula"),
        F.col("value").alias("energia"),
        F.when(missing, F.lit(None).cast("double")).otherwise(lat_raw).alias("latitud"),
        F.when(missing, F.lit(None).cast("double")).otherwise(lon_raw).alias("longitud"),
        F.lit("0.25").alias("precio"),
        F.col("event_type").alias("tipo"),
        F.col("props").alias("categoria"),
        F.concat(F.lit("img/"), uid).alias("imagen"),
        F.concat(F.lit("S"), F.lpad(F.expr(f"{_EPOCH_SQL} div {SNAPSHOT_SECONDS}")
                                    .cast("string"), 8, "0")).alias("uoid"),
        epoch.cast("bigint").alias("epochTime"),
        F.concat(F.date_format("ts", "yyyy-MM-dd "),
                 F.lpad((F.expr("hour(ts) div 3") * 3).cast("string"), 2, "0"),
                 F.lit(":00:00")).alias("realTime"),
        F.concat(F.lit("POINT("), lon_raw.cast("decimal(9,4)").cast("string"), F.lit(" "),
                 lat_raw.cast("decimal(9,4)").cast("string"), F.lit(")")).alias("geo"),
        cluster.alias("clusterId"),
        (F.lit(LAT_BASE) + cluster * F.lit(LAT_STEP)).alias("clusterLatitude"),
        F.lit(LON_BASE).alias("clusterLongitude"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("user_id") % 3 == 0, "coche").when(F.col("user_id") % 3 == 1, "patinete")
         .otherwise("moto").alias("tipoVehiculo"),
        (F.col("value") * F.lit(2e0)).alias("autonomyValue"),
        (F.col("user_id") % 3 + 1).cast("double").alias("seats"),
        F.col("ts").cast("date").alias("ingest_date"),
    )


def read_events(spark: SparkSession, sf_dir: str, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """Scan ``events``; an inclusive date range becomes a pushed ``ts`` filter."""
    ev = spark.read.parquet(events_path(sf_dir))
    if start is not None:
        ev = ev.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        stop = (_dt.date.fromisoformat(end) + _dt.timedelta(days=1)).isoformat()
        ev = ev.where(F.col("ts") < F.lit(stop).cast("timestamp_ntz"))
    return ev


def positions(spark: SparkSession, sf_dir: str, start: str | None = None,
              end: str | None = None) -> DataFrame:
    """Positions of ``sf_dir``; optional inclusive ingestion-date range."""
    return positions_from_events(read_events(spark, sf_dir, start, end))


# DuckDB text of the same derivation; oracle queries start with
# ``WITH positions AS (...)``. Double literals carry an exponent: DuckDB reads
# ``40.4`` as DECIMAL.
DUCKDB_POSITIONS = f"""
SELECT event_id,
  concat('svc', cast(user_id % 4 AS VARCHAR)) AS servicio,
  concat('V', lpad(cast(user_id AS VARCHAR), 6, '0')) AS idVehiculo,
  concat('M', lpad(cast(user_id AS VARCHAR), 6, '0')) AS matricula,
  value AS energia,
  CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN NULL
       ELSE 4.04e1 + floor(value / 2.5e1) * 1e-2 END AS latitud,
  CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN NULL
       ELSE -3.7e0 + (event_id % 4) * 3e-4 END AS longitud,
  '0.25' AS precio, event_type AS tipo, props AS categoria,
  concat('img/', cast(user_id AS VARCHAR)) AS imagen,
  concat('S', lpad(cast(cast(floor(epoch(ts)) AS BIGINT) // {SNAPSHOT_SECONDS} AS VARCHAR), 8, '0')) AS uoid,
  cast(floor(epoch(ts)) AS BIGINT) AS epochTime,
  concat(strftime(ts, '%Y-%m-%d '), lpad(cast(hour(ts) // 3 * 3 AS VARCHAR), 2, '0'), ':00:00') AS realTime,
  concat('POINT(', cast(cast(-3.7e0 + (event_id % 4) * 3e-4 AS DECIMAL(9,4)) AS VARCHAR), ' ',
         cast(cast(4.04e1 + floor(value / 2.5e1) * 1e-2 AS DECIMAL(9,4)) AS VARCHAR), ')') AS geo,
  cast(cast(floor(value / 2.5e1) AS INTEGER) % 8 AS BIGINT) AS clusterId,
  4.04e1 + cast(cast(floor(value / 2.5e1) AS INTEGER) % 8 AS BIGINT) * 1e-2 AS clusterLatitude,
  -3.7e0 AS clusterLongitude,
  ts AS "timestamp",
  CASE user_id % 3 WHEN 0 THEN 'coche' WHEN 1 THEN 'patinete' ELSE 'moto' END AS tipoVehiculo,
  value * 2e0 AS autonomyValue,
  cast(user_id % 3 + 1 AS DOUBLE) AS seats,
  cast(ts AS DATE) AS ingest_date
FROM events
"""


def duckdb_with(body: str, extra_ctes: str = "") -> str:
    """``WITH positions AS (<fixture>) [, more] <body>`` for an oracle text."""
    ctes = f"positions AS ({DUCKDB_POSITIONS})"
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"
