"""The feature view by increments equals the full view."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.operators import features as FT
from flotilla.operators.trips import extract_trips
from flotilla.session import fresh_path
from flotilla.sources import feature_store as FS
from flotilla.sources.fixture import positions


def _rows(df):
    return {tuple(r[k] for k in FT.FEATURE_KEYS): (r.numAvailable, r.numTrips) for r in df.collect()}


@pytest.fixture(scope="module")
def table(spark):
    """Positions with rows that come late, without a vehicle or a service; and their trips."""
    p = positions(spark, SF_SMALL).withColumns({
        "ingest_date": F.date_add("ingest_date", (F.col("event_id") % 2).cast("int")),
        "idVehiculo": F.when(F.col("event_id") % 13 != 0, F.col("idVehiculo")),
        "servicio": F.when(F.col("event_id") % 17 != 0, F.col("servicio"))})
    return p, extract_trips(p, compat=True, with_date=True)


def _write(table, base, first, last, **how):
    p, t = (df.where(F.col(c).between(F.lit(first).cast("date"), F.lit(last).cast("date"))) for df, c in zip(table, ("ingest_date", "trip_date")))
    FS.write_increment(p, t, base, **how)


RUNS = [("2020-01-01", "2024-01-08"), ("2024-01-09", "2024-01-20"), ("2024-01-21", "2030-01-01")]


def test_increments_equal_the_full_view(spark, table):
    want = _rows(FT.cluster_hour_features(*table))
    for order in (RUNS, RUNS[::-1], [RUNS[1], *RUNS, RUNS[0]]):   # any order, runs repeated
        base = fresh_path(spark, "features")
        for first, last in order:
            _write(table, base, first, last)
        assert _rows(FS.read_view(spark, base)) == want
    hours = [c for c in FT.FEATURE_KEYS if not c.startswith("cluster")]
    both = spark.read.parquet(f"{base}/parts").groupBy(*hours).agg(F.countDistinct("part").alias("n"))
    assert both.where("n > 1").count() > 0                        # hours that two dates hold
    # Every vehicle has one number, and the numbers are dense.
    numbers = [tuple(r) for r in FS._numbers(spark, base).collect()]
    assert sorted(n for _, n in numbers) == list(range(len({v for v, _ in numbers})))
    FS.drop_dates(spark, base, ["2024-01-10"])
    rest = [df.where(F.col(c) != F.lit("2024-01-10").cast("date")) for df, c in zip(table, ("ingest_date", "trip_date"))]
    assert _rows(FS.read_view(spark, base)) == _rows(FT.cluster_hour_features(*rest))


def test_numbering_that_broke_off_is_written_anew(spark, table, tmp_path):
    base = str(tmp_path)
    _write(table, base, *RUNS[0])
    known = FS._numbers(spark, base).count()
    broken = tmp_path / "vehicles" / f"from={known:012d}"
    spark.createDataFrame([("ghost", known)], "idVehiculo string, number long").write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    for run in RUNS[1:]:
        _write(table, base, *run)
    assert _rows(FS.read_view(spark, base)) == _rows(FT.cluster_hour_features(*table))
    assert FS._numbers(spark, base).where("idVehiculo = 'ghost'").count() == 0


def test_more_vehicles_than_a_bitmap_holds(spark, table):
    """40,000 vehicles in one hour, seen on two dates."""
    one = table[0].where("clusterId IS NOT NULL").limit(1).drop("idVehiculo", "ingest_date")
    p = one.crossJoin(spark.range(40_000).select(F.col("id").cast("string").alias("idVehiculo")))
    p = p.crossJoin(spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "d string")).withColumn("ingest_date", F.to_date("d"))
    base = fresh_path(spark, "features")
    for d in ("2024-01-01", "2024-01-02"):
        FS.write_increment(p.where(F.col("d") == d), table[1].limit(0), base)
    row, = FS.read_view(spark, base).collect()
    assert (row.numAvailable, row.numTrips) == (40_000, None)


def test_approximate_view(spark, table):
    base = fresh_path(spark, "features")
    for run in RUNS:
        _write(table, base, *run, approximate=True)
    want, got = _rows(FT.cluster_hour_features(*table)), _rows(FS.read_view(spark, base, approximate=True))
    assert got.keys() == want.keys()
    assert all(got[k][1] == want[k][1] and abs((got[k][0] or 0) - (want[k][0] or 0)) <= max(1, 0.1 * (want[k][0] or 0)) for k in want)


def test_empty_increment(spark, table):
    base = fresh_path(spark, "features")
    FS.write_increment(table[0].limit(0), table[1].limit(0), base)
    _write(table, base, "2020-01-01", "2030-01-01")
    assert _rows(FS.read_view(spark, base)) == _rows(FT.cluster_hour_features(*table))


def test_job_by_increments(spark):
    from flotilla.plans import jobs
    from flotilla.sources import tables
    path, store, out = (fresh_path(spark, n) for n in ("positions", "store", "view"))
    tables.write_positions(positions(spark, SF_SMALL), path)
    for start, end in (("2020-01-01", "2024-01-08"), ("2024-01-09", "2024-01-20"), ("2024-01-09", "2024-01-20"), ("2024-01-21", "2030-01-01")):
        jobs.main(["features", "--positions", path, "--out", out, "--start", start, "--end", end, "--store", store], spark)
    whole = tables.read_positions(spark, path)
    assert _rows(spark.read.parquet(out)) == _rows(FT.cluster_hour_features(whole, extract_trips(whole, compat=True)))
