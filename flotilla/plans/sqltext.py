"""Builders for DuckDB oracle texts shared by several queries."""

from __future__ import annotations

from flotilla.functions.geo import pair_distance_sql
from flotilla.operators.trips import _BOTH, _FROM_START
from flotilla.plans.present import sql_present
from flotilla.schema import POSITION_COLUMNS, TRIP_COLUMNS
from flotilla.sources.fixture import duckdb_with

PAIR_ORDER = "epochTime, event_id"

TRIP_DOUBLES = ["distancia"] + [f"{c}_{s}" for c in ("energia", "latitud", "longitud",
                                                     "clusterLatitude", "clusterLongitude")
                                for s in ("start", "end")]
TRIP_TIMESTAMPS = ["timestamp_start", "timestamp_end"]
POSITION_DOUBLES = ["energia", "latitud", "longitud", "clusterLatitude", "clusterLongitude",
                    "autonomyValue", "seats"]


def q(name: str) -> str:
    return f'"{name}"'


def window_clause(pairing: str) -> str:
    if pairing == "vehicle":
        return f"PARTITION BY idVehiculo ORDER BY {PAIR_ORDER}"
    return f"ORDER BY idVehiculo NULLS FIRST, {PAIR_ORDER}"


def pairs_cte(pairing: str, source: str = "positions") -> str:
    """``pairs``: every position with its predecessor's columns as ``s_<col>``."""
    cols = ["event_id", *POSITION_COLUMNS]
    lags = ", ".join(f"lag({q(c)}) OVER w AS {q('s_' + c)}" for c in cols)
    return (f"pairs AS (SELECT *, {lags}, row_number() OVER w AS rn FROM {source} "
            f"WINDOW w AS ({window_clause(pairing)}))")


def trips_select(pairing: str = "vehicle", compat: bool = False, with_ids: bool = False) -> str:
    """SELECT of the 30 trip columns over the ``pairs`` CTE."""
    dist = pair_distance_sql("s_latitud", "s_longitud", "latitud", "longitud", compat)
    sel = {"distancia": "distancia"}
    for c in _FROM_START:
        sel[c] = q("s_" + c)
    for c in _BOTH:
        sel[f"{c}_start"] = q("s_" + c)
        sel[f"{c}_end"] = q(c)
    if compat:
        sel["epochTime_end"] = q("s_epochTime")
        sel["realTime_end"] = q("s_realTime")
    items = [f"{sel[c]} AS {q(c)}" for c in TRIP_COLUMNS]
    if with_ids:
        items += ['"s_event_id" AS event_id_start', "event_id AS event_id_end"]
    return (f"SELECT {', '.join(items)} FROM (SELECT *, {dist} AS distancia FROM pairs WHERE rn > 1) t "
            f"WHERE distancia > 1e-1")


def trips_sql(pairing: str = "vehicle", compat: bool = False, with_ids: bool = False,
              present: bool = True) -> str:
    body = duckdb_with(trips_select(pairing, compat, with_ids), pairs_cte(pairing))
    if not present:
        return body
    return sql_present(body, doubles=TRIP_DOUBLES, timestamps=TRIP_TIMESTAMPS)


def positions_sql(body: str, extra_ctes: str = "", doubles=(), timestamps=(), dates=(), ints=()) -> str:
    return sql_present(duckdb_with(body, extra_ctes), doubles=list(doubles),
                       timestamps=list(timestamps), dates=list(dates), ints=list(ints))


# ------------------------------------------------------------ demand study

FEATURE_KEYS_SQL = ("servicio, tipoVehiculo, year, month, day, weekday, hour, clusterId, "
                    "clusterLatitude, clusterLongitude")

# CTEs: pairs, trips (per-vehicle, compat -- the trips behind the view),
# seen, moved, features.
FEATURES_CTES = pairs_cte("vehicle") + f""",
trips AS ({trips_select("vehicle", compat=True)}),
seen AS (SELECT servicio, tipoVehiculo, year(d) AS year, month(d) AS month, day(d) AS day,
         dayname(d) AS weekday, hour(ts) AS "hour", clusterId, clusterLatitude, clusterLongitude,
         count(DISTINCT idVehiculo) AS numAvailable
         FROM (SELECT *, cast("timestamp" AS DATE) AS d, "timestamp" AS ts FROM positions) x
         GROUP BY ALL),
moved AS (SELECT servicio, tipoVehiculo, year(d) AS year, month(d) AS month, day(d) AS day,
          dayname(d) AS weekday, hour(ts) AS "hour", clusterId_start AS clusterId,
          clusterLatitude_start AS clusterLatitude, clusterLongitude_start AS clusterLongitude,
          count(*) AS numTrips
          FROM (SELECT *, cast(timestamp_start AS DATE) AS d, timestamp_start AS ts FROM trips) x
          GROUP BY ALL),
features AS (SELECT * FROM seen FULL OUTER JOIN moved USING ({FEATURE_KEYS_SQL}))"""

CLEAN_CTE = """clean AS (SELECT servicio, tipoVehiculo, weekday, "hour", clusterId, numAvailable,
         coalesce(numTrips, 0) AS numTrips FROM features
         WHERE weekday = 'Thursday' AND numAvailable <> 0)"""

def hash_bucket_sql(key: str, modulo: int) -> str:
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT % {modulo})"


def ols_ctes(train: str, x: list[str], y: str, alpha: float = 0.0) -> str:
    """Closed-form least squares (3 features) by Cramer's rule on the
    population covariance matrix; ``alpha`` adds alpha/n on the diagonal
    (ridge with an unpenalised intercept). CTE ``coef`` has b, w1, w2, w3."""
    x1, x2, x3 = (f'"{c}"' for c in x)
    yy = f'"{y}"'
    cov = []
    names = {1: x1, 2: x2, 3: x3}
    for i in range(1, 4):
        for j in range(i, 4):
            cov.append(f"covar_pop({names[i]}, {names[j]}) AS c{i}{j}")
        cov.append(f"covar_pop({names[i]}, {yy}) AS r{i}")
    diag = f"{alpha!r}e0 / n"
    return f"""st AS (SELECT count(*) AS n, avg({x1}) AS m1, avg({x2}) AS m2, avg({x3}) AS m3, avg({yy}) AS my,
  {', '.join(cov)} FROM {train}),
mt AS (SELECT *, c11 + {diag} AS a11, c12 AS a12, c13 AS a13, c22 + {diag} AS a22, c23 AS a23,
  c33 + {diag} AS a33 FROM st),
dt AS (SELECT *, a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13)
  + a13 * (a12 * a23 - a22 * a13) AS det FROM mt),
cw AS (SELECT *,
  (r1 * (a22 * a33 - a23 * a23) - a12 * (r2 * a33 - a23 * r3) + a13 * (r2 * a23 - a22 * r3)) / det AS w1,
  (a11 * (r2 * a33 - a23 * r3) - r1 * (a12 * a33 - a23 * a13) + a13 * (a12 * r3 - r2 * a13)) / det AS w2,
  (a11 * (a22 * r3 - r2 * a23) - a12 * (a12 * r3 - r2 * a13) + r1 * (a12 * a23 - a22 * a13)) / det AS w3
  FROM dt),
coef AS (SELECT w1, w2, w3, my - w1 * m1 - w2 * m2 - w3 * m3 AS b FROM cw)"""
