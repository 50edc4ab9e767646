"""Versioned vehicle-state table, merged on read.

A version is either *full* (one row per plate, in folders by a bucket of the
plate) or a *delta* (only the plates a step changed, a small table). Reading a version takes the
newest full one up to it and the deltas since, and of each plate the newest row;
deltas are small, so Spark broadcasts their plates and the full table isn't
shuffled. An update writes what it changes; :func:`compact` rewrites the state
every so many deltas, and :func:`expire` removes versions no reader needs.

Writers never overwrite the version they read: an update reads version *k*
and writes version *k + 1*, which records the step that made it (a day's
fold, a snapshot, a micro-batch). The note of the step is written first, and a
version counts once its data is complete, so no version is without its step
wherever a writer stops. A rerun of the newest step starts from the version
before it again and rewrites the same version, so retries are idempotent; a rerun
of an older step is refused, because later versions were built on it.

    state/v=N        full version N          state/d=N       delta version N
    state-merged/v=N version N compacted     state-steps/N-<digest of the step>
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flotilla.sources.files import complete as _complete, delete as _drop, names as _names, path_and_system as _file

PLATE = "matricula"
BUCKET = "plate_bucket"
BUCKETS = 8
#: Deltas since the last full version after which an update compacts the state.
MAX_DELTAS = 8


def version_path(base: str, version: int, delta: bool = False) -> str:
    return os.path.join(base, "state", f"{'d' if delta else 'v'}={version:010d}")


def _merged_path(base: str, version: int) -> str:
    return os.path.join(base, "state-merged", f"v={version:010d}")


def _bucket(plate: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(plate), F.lit(buckets)).cast("int")


# -------------------------------------------------------------------- writing

def _digest(step: str | None) -> str:
    return hashlib.sha1(json.dumps(step).encode()).hexdigest()


def _note(spark: SparkSession, base: str, version: int, step: str | None, more: dict) -> None:
    folder = os.path.join(base, "state-steps")
    for name in _names(spark, folder):
        if int(name.split("-")[0]) == version:
            _drop(spark, os.path.join(folder, name))
    p, fs = _file(spark, os.path.join(folder, f"{version:010d}-{_digest(step)}"))
    out = fs.create(p, True)
    out.write(bytearray(json.dumps({"step": step, **more}).encode()))
    out.close()


def _write(state: DataFrame, base: str, version: int, step: str | None, delta: bool, plate: str, buckets: int, more: dict) -> str:
    spark = state.sparkSession
    before = step_of(spark, base, version - 1)
    kept = {k: v for k, v in before.items() if k not in ("step", "schema", "plate", "buckets", "late")}
    path = version_path(base, version, delta)
    for v in _complete(spark, os.path.join(base, "state-merged")):
        if int(v[2:]) >= version:  # made from what is now replaced
            _drop(spark, os.path.join(base, "state-merged", v))
    for old in (path, version_path(base, version, not delta)):
        _drop(spark, old)
    _note(spark, base, version, step, {**kept, **more, "schema": state.schema.json(), "plate": plate, "buckets": buckets})
    if delta:
        _write_delta(state, path)
    else:
        _write_table(state, path, plate, buckets)
    return path


def _write_delta(changed: DataFrame, path: str) -> None:
    changed.write.mode("overwrite").parquet(path)


def _write_table(state: DataFrame, path: str, plate: str, buckets: int) -> None:
    state.withColumn(BUCKET, _bucket(plate, buckets)).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def write_version(state: DataFrame, base: str, version: int, step: str | None = None, plate: str = PLATE, buckets: int = BUCKETS, **more) -> str:
    """Write a full version and note its step and whatever else is given (such
    notes are handed on to later versions)."""
    return _write(state, base, version, step, False, plate, buckets, more)


def write_delta(changed: DataFrame, base: str, version: int, step: str | None = None, plate: str = PLATE, **more) -> str:
    """Write a version by the rows that differ from the version before: one per
    changed or new plate, in the state's types. The state is compacted when many
    deltas have come together."""
    spark = changed.sparkSession
    before = step_of(spark, base, version - 1)
    buckets = before.get("buckets", BUCKETS)
    changed = changed.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromJson(json.loads(before["schema"]))])
    path = _write(changed, base, version, step, True, plate, buckets, more)
    if len(_parts(spark, base, version)[1]) > MAX_DELTAS:
        compact(spark, base, version)
    return path


def compact(spark: SparkSession, base: str, version: int | None = None) -> str:
    """Store a version (the latest) merged, as a full table beside it: the same
    state, read without its deltas. Safe to repeat and to lose."""
    version = latest_version(spark, base) if version is None else version
    note, path = step_of(spark, base, version), _merged_path(base, version)
    if f"v={version:010d}" not in _complete(spark, os.path.join(base, "state-merged")):
        _write_table(read_version(spark, base, version), path, note.get("plate", PLATE), note.get("buckets", BUCKETS))
    return path


def expire(spark: SparkSession, base: str, keep: int = 2) -> list[int]:
    """Remove versions that none of the last ``keep`` versions is read from."""
    have = versions(spark, base)
    if len(have) <= keep:
        return []
    root, deltas = _parts(spark, base, have[-keep])
    first = int(os.path.basename(root)[2:])
    merged = "state-merged" in root
    gone = [v for v in have if v < have[-keep] and v not in deltas and (merged or v != first)]
    for v in gone:
        for path in (version_path(base, v), version_path(base, v, True), _merged_path(base, v)):
            if path != root:
                _drop(spark, path)
    return gone


# -------------------------------------------------------------------- reading

def step_of(spark: SparkSession, base: str, version: int) -> dict:
    """What was noted of a version's step."""
    for name in _names(spark, os.path.join(base, "state-steps")):
        if int(name.split("-")[0]) == version:
            p, fs = _file(spark, os.path.join(base, "state-steps", name))
            source = fs.open(p)
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
            source.close()
            return json.loads(text)
    return {"step": None}


def begin_step(spark: SparkSession, base: str, step: str) -> tuple[int, int]:
    """(version to read, version to write) for ``step``. One listing tells which
    steps made the versions; none of their notes is opened."""
    have = versions(spark, base)
    if not have:
        raise FileNotFoundError(f"no state version under {base}")
    made = {int(n.split("-")[0]) for n in _names(spark, os.path.join(base, "state-steps")) if n.endswith(_digest(step))} & set(have)
    if not made:
        return have[-1], have[-1] + 1
    newest = max(made)
    if newest != have[-1]:
        raise ValueError(f"{step} made version {newest}, and {have[-1]} was built on it: remove the later versions first")
    if len(have) < 2:
        raise ValueError(f"{step} made version {newest}, and the version before it is gone: it can't be repeated")
    return have[-2], newest


def versions(spark: SparkSession, base: str) -> list[int]:
    """Complete versions under ``base`` (Hadoop FS listing, any file system)."""
    return sorted({int(n[2:]) for n in _complete(spark, os.path.join(base, "state")) if n[:2] in ("v=", "d=")})


def latest_version(spark: SparkSession, base: str) -> int:
    v = versions(spark, base)
    if not v:
        raise FileNotFoundError(f"no state version under {base}")
    return v[-1]


def _parts(spark: SparkSession, base: str, version: int) -> tuple[str, list[int]]:
    """The full table a version is read from, and the deltas since, ascending."""
    names = _complete(spark, os.path.join(base, "state"))
    full = {int(n[2:]): version_path(base, int(n[2:])) for n in names if n.startswith("v=")}
    full |= {int(n[2:]): _merged_path(base, int(n[2:])) for n in _complete(spark, os.path.join(base, "state-merged"))}
    roots = [v for v in full if v <= version]
    if not roots or version not in versions(spark, base):
        raise FileNotFoundError(f"no state version {version} under {base}")
    root = max(roots)
    return full[root], sorted(int(n[2:]) for n in names if n.startswith("d=") and root < int(n[2:]) <= version)


def read_version(spark: SparkSession, base: str, version: int | None = None, plates: Sequence[str] | None = None) -> DataFrame:
    """The state of a version (the latest): one row per plate. With ``plates``,
    only those, from the folders of their buckets."""
    version = latest_version(spark, base) if version is None else version
    root, deltas = _parts(spark, base, version)
    note = step_of(spark, base, version)
    plate, buckets = note.get("plate", PLATE), note.get("buckets", BUCKETS)
    schema = T.StructType.fromJson(json.loads(note["schema"]))
    stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])

    def table(path: str) -> DataFrame:  # a delta
        df = spark.read.schema(schema).parquet(path)
        return df if plates is None else df.where(F.col(plate).isin(list(plates)))

    full = spark.read.schema(stored).parquet(root)
    if plates is not None:
        wanted = spark.createDataFrame([(p,) for p in plates], "p string").select(_bucket("p", buckets).alias("b")).distinct()
        full = full.where(F.col(BUCKET).isin([r.b for r in wanted.collect()]) & F.col(plate).isin(list(plates)))  # at most ``buckets`` rows
    full = full.drop(BUCKET)
    if not deltas:
        return full
    # Each delta holds a plate once, so the newest row of a plate is that of the newest delta.
    changed = table(version_path(base, deltas[-1], True))
    if len(deltas) > 1:
        row = F.struct(*schema.names)
        every = [table(version_path(base, d, True)).select(row.alias("r"), F.col(plate).alias("k"), F.lit(d).alias("d")) for d in deltas]
        for other in every[1:]:
            every[0] = every[0].unionByName(other)
        changed = every[0].groupBy("k").agg(F.max_by("r", "d").alias("r")).select("r.*")
    return full.join(changed.select(plate), plate, "left_anti").select(*schema.names).unionByName(changed)
