"""Sources and sinks queries: range scans, round trips, REQUIRED checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from flotilla.operators import snapshots as S
from flotilla.operators.trips import extract_trips, last_rows
from flotilla.plans.catalog import register
from flotilla.plans.present import sql_present
from flotilla.plans.q_snapshots import STATE_CTE, snapshot_positions, state_of
from flotilla.plans.sqltext import POSITION_DOUBLES, TRIP_DOUBLES, TRIP_TIMESTAMPS, positions_sql, trips_sql
from flotilla.schema import NUMERIC_TO_DOUBLE, POSITION_COLUMNS, POSITION_REQUIRED
from flotilla.session import fresh_path
from flotilla.sources import tables
from flotilla.sources.fixture import RANGE_END, RANGE_START, SNAPSHOT_ID, positions

_ALL = dict(doubles=POSITION_DOUBLES, timestamps=["timestamp"], dates=["ingest_date"])
_RANGE_SQL = positions_sql(
    f"SELECT * FROM positions WHERE ingest_date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'", **_ALL)


@register("scan_positions_range", _RANGE_SQL)
def scan_positions_range(spark, sf_dir):
    """Inclusive date range, pushed into the parquet scan as a ts filter."""
    return positions(spark, sf_dir, RANGE_START, RANGE_END)


@register("positions_table_range", _RANGE_SQL)
def positions_table_range(spark, sf_dir):
    """S1 on an ingestion-date partitioned table: partition pruning."""
    path = fresh_path(spark, "positions")
    tables.write_positions(positions(spark, sf_dir), path, mode="append")
    return tables.read_positions(spark, path, RANGE_START, RANGE_END).select(*positions(spark, sf_dir).columns)


@register("snapshot_copy", positions_sql(
    f"SELECT {', '.join(POSITION_COLUMNS)}, ingest_date FROM positions WHERE uoid = '{SNAPSHOT_ID}'",
    doubles=[c for c in POSITION_DOUBLES if c in POSITION_COLUMNS], timestamps=["timestamp"], dates=["ingest_date"]))
def snapshot_copy(spark, sf_dir):
    """K2: append a snapshot's rows to the copy table (19 declared columns)."""
    path = fresh_path(spark, "snapshot_copy")
    snap = snapshot_positions(spark, sf_dir, SNAPSHOT_ID).select(*POSITION_COLUMNS, "ingest_date")
    tables.write_positions(snap, path, mode="append")
    return spark.read.parquet(path).select(*POSITION_COLUMNS, "ingest_date")


@register("trips_write_roundtrip", sql_present(
    f"SELECT *, cast(timestamp_end AS DATE) AS trip_date FROM ({trips_sql('vehicle', present=False)}) t",
    doubles=TRIP_DOUBLES, timestamps=TRIP_TIMESTAMPS, dates=["trip_date"]))
def trips_write_roundtrip(spark, sf_dir):
    """K1: trips written twice with dynamic partition overwrite (a rerun) and
    read back -- no duplicates."""
    path = fresh_path(spark, "trips")
    trips = extract_trips(positions(spark, sf_dir))
    tables.write_trips(trips, path, rerun_safe=True)
    tables.write_trips(trips, path, rerun_safe=True)
    return tables.read_trips(spark, path)


@register("trips_incremental_write", sql_present(
    f"SELECT *, cast(timestamp_end AS DATE) AS trip_date FROM ({trips_sql('vehicle', present=False)}) t "
    f"WHERE cast(timestamp_end AS DATE) <= DATE '{RANGE_END}'",
    doubles=TRIP_DOUBLES, timestamps=TRIP_TIMESTAMPS, dates=["trip_date"]))
def trips_incremental_write(spark, sf_dir):
    """K1: the days before a range, then the range with the last rows carried in,
    the range twice, all into one folder: equal to one run over everything."""
    path = fresh_path(spark, "trips")
    before = (dt.date.fromisoformat(RANGE_START) - dt.timedelta(days=1)).isoformat()
    early, rng = positions(spark, sf_dir, end=before), positions(spark, sf_dir, RANGE_START, RANGE_END)
    tables.write_trips(extract_trips(early, with_date=True), path)
    for _ in range(2):
        trips = extract_trips(rng, carry_in=last_rows(early), with_date=True)
        tables.write_trips(trips, path, dates=(RANGE_START, RANGE_END))
    return tables.read_trips(spark, path)


_JSON_COLS = ["event_id", *POSITION_COLUMNS, "autonomyValue", "seats"]


_JSON_SELECT = ", ".join(
    c if c != "timestamp" else "strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S.%f') AS \"timestamp\""
    for c in _JSON_COLS)


@register("snapshot_json_roundtrip", positions_sql(
    f"SELECT {_JSON_SELECT} FROM positions WHERE uoid = '{SNAPSHOT_ID}'", doubles=POSITION_DOUBLES))
def snapshot_json_roundtrip(spark, sf_dir):
    """K3 + P6: snapshot as JSON lines (timestamp as text) and read back."""
    path = fresh_path(spark, "json")
    snap = snapshot_positions(spark, sf_dir, SNAPSHOT_ID).select(*_JSON_COLS)
    tables.write_json(snap, path)
    schema = tables.to_json_ready(snap).schema
    return tables.read_json(spark, path, schema)


_LEGACY_COLS = ["matricula", "idVehiculo", "uoid", "realTime", "epochTime", "energia", "latitud",
                "longitud", "seats"]


@register("legacy_state_text_read", positions_sql(
    f"SELECT {', '.join(_LEGACY_COLS)}, strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S.%f') AS \"timestamp\", "
    "latitud IS NOT NULL AS has_position FROM state", STATE_CTE,
    doubles=["energia", "latitud", "longitud", "seats"]))
def legacy_state_text_read(spark, sf_dir):
    """The state written as Python dict reprs and parsed back."""
    path = fresh_path(spark, "legacy")
    st = state_of(spark, sf_dir).select(*_LEGACY_COLS, "timestamp",
                                        F.col("latitud").isNotNull().alias("has_position"))
    st = tables.to_json_ready(st)
    tables.write_legacy_text(st, path)
    return tables.read_legacy_text(spark, path, st.schema)


#: Text that a cut at braces or a swap of quotes would break.
_HARD = [("O'Brien {", "}, 'x': None"), ('say "', '" \\ True'), ("it's \"", "\"\t\n}{"), ("", "")]


def _hard_sql(side: int) -> str:
    texts = ", ".join("'" + pair[side].replace("'", "''") + "'" for pair in _HARD)
    return f"(ARRAY[{texts}])[1 + event_id % {len(_HARD)}]"


@register("legacy_repr_read", positions_sql(
    f"SELECT event_id, {_hard_sql(0)} || matricula || {_hard_sql(1)} AS \"it's\", nullif({_hard_sql(1)}, '') AS \"{{k}}\", latitud, "
    "latitud IS NOT NULL AS has_position FROM state", STATE_CTE, doubles=["latitud"]))
def legacy_repr_read(spark, sf_dir):
    """Dict reprs whose keys and values hold quotes of both styles, braces, escapes and None."""
    def side(i: int):
        return F.element_at(F.array(*[F.lit(pair[i]) for pair in _HARD]), (F.col("event_id") % len(_HARD) + 1).cast("int"))
    path = fresh_path(spark, "legacy-repr")
    st = state_of(spark, sf_dir).select("event_id", F.concat(side(0), "matricula", side(1)).alias("it's"),
                                        F.nullif(side(1), F.lit("")).alias("{k}"), "latitud", F.col("latitud").isNotNull().alias("has_position"))
    tables.write_legacy_text(st, path)
    return tables.read_legacy_text(spark, path, st.schema)


_HOLES = {"geo": 7, "clusterId": 11}  # every so many rows lack the column


@register("required_field_check_holes", positions_sql(
    "SELECT (" + " AND ".join(f"event_id % {_HOLES[c]} <> 0" if c in _HOLES else f'"{c}" IS NOT NULL' for c in POSITION_REQUIRED)
    + ") AS required_ok, count(*) AS n_rows FROM positions GROUP BY 1"))
def required_field_check_holes(spark, sf_dir):
    """K5 on rows that lack REQUIRED columns: both groups, written and read back."""
    p = positions(spark, sf_dir).withColumns({c: F.when(F.col("event_id") % n != 0, F.col(c)) for c, n in _HOLES.items()})
    good, bad = fresh_path(spark, "required"), fresh_path(spark, "rejects")
    tables.write_positions(p, good, mode="overwrite", rejects_path=bad)
    both = spark.read.parquet(good).select(F.lit(True).alias("required_ok")).unionByName(spark.read.parquet(bad).select(F.lit(False).alias("required_ok")))
    return both.groupBy("required_ok").agg(F.count(F.lit(1)).alias("n_rows"))


@register("positions_decimal_read", _RANGE_SQL)
def positions_decimal_read(spark, sf_dir):
    """S1 / P5 on a table at rest with NUMERIC columns as decimal(38,9): read with
    the declared types, a range of it."""
    path = fresh_path(spark, "decimals")
    p = positions(spark, sf_dir)
    stored = p.withColumns({c: F.col(c).cast("decimal(38,9)") for c in [*NUMERIC_TO_DOUBLE, "clusterLatitude", "clusterLongitude"]})
    tables.write_positions(stored, path)
    return tables.read_positions(spark, path, RANGE_START, RANGE_END).select(*p.columns)


@register("required_field_check", positions_sql(
    "SELECT (" + " AND ".join(f'"{c}" IS NOT NULL' for c in POSITION_REQUIRED)
    + ") AS required_ok, count(*) AS n_rows FROM positions GROUP BY 1"))
def required_field_check(spark, sf_dir):
    """K5: rows passing / failing the REQUIRED columns of the position table."""
    p = positions(spark, sf_dir)
    return p.groupBy(tables.required_ok(POSITION_REQUIRED).alias("required_ok")) \
            .agg(F.count(F.lit(1)).alias("n_rows"))

