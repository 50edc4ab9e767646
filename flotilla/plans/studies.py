"""Composed jobs: the reference's four workloads as functions of DataFrames.

* :func:`trip_job`       -- A: positions of a date range -> trips (sink optional)
* :func:`snapshot_job`   -- B: one snapshot vs. the state -> movements, upserted state
* :func:`fold_job`       -- C: replay a day's snapshots over the state
* :func:`demand_study`   -- D: features -> clean -> split -> model -> errors
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flotilla.operators import cart
from flotilla.operators import evaluate as E
from flotilla.operators import features as FT
from flotilla.operators import models as M
from flotilla.operators import snapshots as S
from flotilla.operators import state as ST
from flotilla.operators.trips import extract_trips, trip_starts
from flotilla.session import cut_lineage
from flotilla.sources import fixture, tables

KEY = "row_key"


def trip_job(positions: DataFrame, out_path: str | None = None, pairing: str = "vehicle",
             compat: bool = False, metrics: dict | None = None, carry_in: DataFrame | None = None,
             dates: tuple[str, str] | None = None, audit: bool = False,
             rejects_path: str | None = None) -> DataFrame:
    """Workload A. With ``out_path`` the trips are written rerun-safe, by end
    date (see :func:`flotilla.sources.tables.write_trips`).

    ``metrics`` (a dict) receives the pipeline counters of the write
    (rows in, trips written, mean distance) through ``DataFrame.observe``:
    collected as a side effect of the write, no extra pass over the data.
    """
    obs_in, obs_out = Observation("positions"), Observation("trips")
    pos = positions.observe(obs_in, F.count(F.lit(1)).alias("rows_in"))
    trips = extract_trips(pos, pairing=pairing, compat=compat, carry_in=carry_in,
                          with_date=bool(out_path))
    if out_path:
        observed = trips.observe(obs_out, F.count(F.lit(1)).alias("trips"),
                                 F.avg("distancia").alias("mean_km"))
        tables.write_trips(observed, out_path, rerun_safe=True, dates=dates, audit=audit, rejects_path=rejects_path)
        if metrics is not None:
            metrics.update(obs_in.get)
            metrics.update(obs_out.get)
    return trips


def snapshot_job(positions: DataFrame, state: DataFrame, uoid: str, keep: str = "first"):
    """Workload B: (rows with movement class, new state). The state is not
    written here; callers write it to a new version path."""
    snap = S.cast_numeric(S.snapshot_by_id(positions, uoid))
    compared = S.compare_with_state(snap, state)
    new_state = ST.upsert_state(state, S.dedupe_snapshots(snap, keep=keep).select(*state.columns))
    return compared, new_state


def fold_job(positions: DataFrame, state: DataFrame, day: str, add_new: bool = False):
    """Workload C: (final state, move log)."""
    return (ST.fold_state(state, positions, day, add_new=add_new),
            ST.movement_log(state, positions, day, add_new=add_new))


def features_of(positions: DataFrame) -> DataFrame:
    """The feature view from positions and their (per-vehicle, compat) trips."""
    return FT.cluster_hour_features(positions, trip_starts(positions, compat=True))


def features_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_of(fixture.positions(spark, sf_dir))


def study_input(features: DataFrame, vehicle_type: str | None = None,
                weekday: str | None = "Thursday") -> DataFrame:
    clean = FT.clean_demand(features, weekday=weekday, key_col=KEY)
    if vehicle_type:
        clean = clean.where(F.col("tipoVehiculo") == F.lit(vehicle_type))
    return FT.label_yes_no(clean).withColumn("tripYesNo", F.col("tripYesNo").cast("double"))


def demand_study(features: DataFrame, vehicle_type: str | None, feature_cols: Sequence[str],
                 label: str, kind: str, seed: int = 1, with_pct: bool = True) -> DataFrame:
    """M9: one parameterised study. Returns the test rows with Real,
    Prediction, Err (and ErrPorcentage).

    The study table (cleaned hourly features: small next to the positions)
    is written to the shared folder and read back first: the fit makes several passes
    and each would otherwise recompute pairing, trips and features."""
    data = cut_lineage(E.with_split(study_input(features, vehicle_type), [KEY]))
    train = data.where(F.col("is_train")).drop("is_train")
    test = data.where(~F.col("is_train")).drop("is_train")
    if kind.startswith("exact_"):
        pred = cart.predict_rows(train, test, feature_cols, label, kind, [KEY])
    else:
        _, pred = M.fit_predict(train, test, feature_cols, label, kind, seed=seed)
    out = E.errors(pred, available="numAvailable" if with_pct else None)
    cols = [KEY, *feature_cols, "numAvailable", "Real", "Prediction", "Err"]
    if with_pct:
        cols.append("ErrPorcentage")
    return out.select(*dict.fromkeys(cols))
