"""Declared schemas of the position, trip, state and feature tables.

Field names, their order and REQUIRED/NULLABLE modes are the storage
contract of the positions and trips tables and are fixed values.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the position snapshot table, in order.
POSITION_COLUMNS = [
    "servicio", "idVehiculo", "matricula", "energia", "latitud", "longitud",
    "precio", "tipo", "categoria", "imagen", "uoid", "epochTime", "realTime",
    "geo", "clusterId", "clusterLatitude", "clusterLongitude", "timestamp",
    "tipoVehiculo",
]
# REQUIRED columns of the position table.
POSITION_REQUIRED = [
    "uoid", "epochTime", "realTime", "geo", "clusterId", "clusterLatitude",
    "clusterLongitude", "timestamp", "tipoVehiculo",
]
# The second provider adds these NUMERIC columns.
PROVIDER_B_EXTRA = ["autonomyValue", "seats"]
# NUMERIC columns cast to float before use (second provider).
NUMERIC_TO_DOUBLE = ["energia", "latitud", "longitud", "epochTime", "autonomyValue", "seats"]

# Trip table columns, in order (30 columns).
TRIP_COLUMNS = [
    "distancia", "servicio", "idVehiculo", "matricula",
    "energia_start", "energia_end", "latitud_start", "latitud_end",
    "longitud_start", "longitud_end", "precio", "tipo", "categoria", "imagen",
    "uoid", "epochTime_start", "epochTime_end", "realTime_start", "realTime_end",
    "geo_start", "geo_end", "clusterId_start", "clusterId_end",
    "clusterLatitude_start", "clusterLatitude_end",
    "clusterLongitude_start", "clusterLongitude_end",
    "timestamp_start", "timestamp_end", "tipoVehiculo",
]
# REQUIRED columns of the trip table (everything from uoid on).
TRIP_REQUIRED = TRIP_COLUMNS[TRIP_COLUMNS.index("uoid"):]

POSITION_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("servicio", T.StringType(), True),
    T.StructField("idVehiculo", T.StringType(), True),
    T.StructField("matricula", T.StringType(), True),
    T.StructField("energia", T.DoubleType(), True),
    T.StructField("latitud", T.DoubleType(), True),
    T.StructField("longitud", T.DoubleType(), True),
    T.StructField("precio", T.StringType(), True),
    T.StructField("tipo", T.StringType(), True),
    T.StructField("categoria", T.StringType(), True),
    T.StructField("imagen", T.StringType(), True),
    T.StructField("uoid", T.StringType(), True),
    T.StructField("epochTime", T.LongType(), True),
    T.StructField("realTime", T.StringType(), True),
    T.StructField("geo", T.StringType(), True),
    T.StructField("clusterId", T.LongType(), True),
    T.StructField("clusterLatitude", T.DoubleType(), True),
    T.StructField("clusterLongitude", T.DoubleType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("tipoVehiculo", T.StringType(), True),
    T.StructField("autonomyValue", T.DoubleType(), True),
    T.StructField("seats", T.DoubleType(), True),
    T.StructField("ingest_date", T.DateType(), True),
])
