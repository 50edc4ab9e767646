"""Sources and sinks: legacy text, JSON, trips rerun, partition pruning, batches."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from flotilla.operators.trips import extract_trips
from flotilla.session import fresh_path
from flotilla.sources import tables
from flotilla.sources.fixture import positions


def test_legacy_text_two_records(spark):
    path = fresh_path(spark, "legacy-test")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.txt"), "w") as f:
        f.write("{'matricula': 'M1', 'latitud': 40.4, 'ok': True}\n"
                "{'matricula': 'M2', 'latitud': None, 'ok': False}\n")
    schema = "matricula string, latitud double, ok boolean"
    got = sorted(map(tuple, tables.read_legacy_text(spark, path, spark.createDataFrame([], schema).schema)
                     .collect()))
    assert got == [("M1", 40.4, True), ("M2", None, False)]


def test_json_roundtrip_keeps_rows(spark):
    p = positions(spark, SF_SMALL).select("event_id", "matricula", "latitud", "timestamp")
    path = fresh_path(spark, "json-test")
    tables.write_json(p, path)
    back = tables.read_json(spark, path, tables.to_json_ready(p).schema)
    assert back.count() == p.count()
    assert back.schema["timestamp"].dataType.simpleString() == "string"


def test_trips_rerun_adds_no_rows(spark):
    trips = extract_trips(positions(spark, SF_SMALL))
    path = fresh_path(spark, "trips-test")
    tables.write_trips(trips, path)
    tables.write_trips(trips, path)
    assert tables.read_trips(spark, path).count() == trips.count() == 702
    tables.write_trips(trips, path, rerun_safe=False)     # the reference's append duplicates
    assert tables.read_trips(spark, path).count() == 2 * 702


def test_positions_range_prunes_partitions(spark):
    path = fresh_path(spark, "positions-test")
    tables.write_positions(positions(spark, SF_SMALL), path)
    df = tables.read_positions(spark, path, "2024-01-05", "2024-01-20")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert df.count() == positions(spark, SF_SMALL).where(
        F.col("ingest_date").between("2024-01-05", "2024-01-20")).count()


def test_range_filter_pushed_to_scan(spark):
    df = positions(spark, SF_SMALL, "2024-01-05", "2024-01-20")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_required_split(spark):
    df = spark.createDataFrame([(1, "u"), (2, None)], "id int, uoid string")
    ok, bad = tables.split_required(df, ["uoid"])
    assert [r.id for r in ok.collect()] == [1] and [r.id for r in bad.collect()] == [2]


def test_chunk_rows_cover_every_row(spark):
    p = positions(spark, SF_SMALL).select("event_id", "idVehiculo", "epochTime")
    ch = tables.chunk_rows(p, 400).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in ch] == [400, 400, 200]


def test_write_keyed_batches(spark, tmp_path):
    out = tmp_path / "batches"
    out.mkdir()

    def sink(batch, root=str(out)):
        import uuid
        with open(os.path.join(root, uuid.uuid4().hex), "w") as f:
            f.write("\n".join(k for k, _ in batch))

    df = positions(spark, SF_SMALL).select("matricula", "event_id").repartition(3)
    tables.write_keyed_batches(df, "matricula", sink, batch_size=400)
    lines = [ln for p in out.iterdir() for ln in p.read_text().splitlines()]
    assert len(lines) == 1000


def test_incremental_trips_equal_full_run(spark):
    from flotilla.operators.trips import last_rows_before
    full = extract_trips(positions(spark, SF_SMALL), with_ids=True)
    start, end = "2024-01-05", "2024-01-20"
    rng = positions(spark, SF_SMALL, start, end)
    inc = extract_trips(rng, with_ids=True, carry_in=last_rows_before(positions(spark, SF_SMALL), start))
    want = full.where(F.to_date("timestamp_end").between(start, end)).select("event_id_start", "event_id_end")
    got = inc.select("event_id_start", "event_id_end")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_audit_column(spark):
    trips = extract_trips(positions(spark, SF_SMALL))
    path = fresh_path(spark, "trips-audit")
    tables.write_trips(trips, path, audit=True)
    v = tables.read_trips(spark, path).select("processed_at").first()[0]
    assert len(v) == 8 and v[2] == ":" and v[5] == ":"


def test_trip_job_metrics(spark):
    from flotilla.plans.studies import trip_job
    m = {}
    trip_job(positions(spark, SF_SMALL), out_path=fresh_path(spark, "trips-job"), metrics=m)
    assert m["trips"] == 702 and m["rows_in"] == 1000 and m["mean_km"] > 0.1


def test_young_state_queries_are_not_empty(spark):
    """The fixture can fail: unknown plates, missing REQUIRED columns, decimals."""
    from flotilla.plans import catalog
    catalog.load_all()
    run = lambda name: [tuple(r) for r in catalog.QUERIES[name](spark, SF_SMALL).collect()]
    assert run("new_vehicles_young_state") and len(run("required_field_check_holes")) == 2
    assert sorted(run("state_fold_young_state")) != sorted(run("state_fold_add_new_young_state"))


def test_write_with_rejects(spark):
    trips = extract_trips(positions(spark, SF_SMALL))
    broken = trips.withColumn("uoid", F.when(F.col("distancia") > 2, F.lit(None)).otherwise(F.col("uoid")))
    path, rej = fresh_path(spark, "trips-req"), fresh_path(spark, "trips-rej")
    tables.write_trips(broken, path, rejects_path=rej)
    n_bad = trips.where(F.col("distancia") > 2).count()
    assert spark.read.parquet(rej).count() == n_bad > 0
    assert tables.read_trips(spark, path).count() == 702 - n_bad


HARD_TEXTS = ["O'Brien", "B}x", "a}b{c", 'say "x"\\y', "it's \"both\"", "None", "True, 'x': False", "line\n\ttab\r\x00\x7f\x85\u2028", "\\x41 \\", "\\\\'", "",
              " , ", "é日本\U0001f600\U000e0001\ud7ff", "{'a': 1}", "'" * 3, '"' * 2, "x" * 300_000 + "'}", "}\n{"]


def test_reprs_written_by_python(spark):
    """Files of repr, with every kind of value, several records on a line, and lists of records."""
    rows = [{"matricula": t, "n's": i, "lat": i / 7 if i % 3 else None, "ok": [True, False, None][i % 3], "more": t[::-1]} for i, t in enumerate(HARD_TEXTS)]
    rows += [{"matricula": "inf", "n's": -(2 ** 40), "lat": float("-inf"), "ok": True, "more": None}, {"matricula": "exp", "n's": 0, "lat": 1e-300, "ok": None, "more": "x"}]
    path = fresh_path(spark, "repr")
    os.makedirs(path)
    with open(os.path.join(path, "a.txt"), "w", newline="") as f:
        f.write("\n".join(map(repr, rows[:6])) + "\n\n  \n" + "".join(map(repr, rows[6:10])) + "\r\n" + repr(rows[10:]) + "\n{}")
    schema = spark.createDataFrame([], "matricula string, `n's` long, lat double, ok boolean, more string, gone int").schema
    got = [r.asDict() for r in tables.read_legacy_text(spark, path, schema).collect()]
    want = [{**r, "gone": None} for r in rows] + [dict.fromkeys(schema.names)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_written_reprs_are_pythons(spark):
    """Python reads what the writer writes, and the reader gives the rows back."""
    import ast
    rows = [(t, i, i / 3, i % 2 == 0) for i, t in enumerate(HARD_TEXTS)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "`a 'b' {c}` string, n long, d double, ok boolean").withColumnRenamed("a 'b' {c}", "k{e}y's")
    path = fresh_path(spark, "legacy-hard")
    tables.write_legacy_text(df, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert sorted((tuple(ast.literal_eval(x).values()) for x in lines), key=repr) == sorted(rows, key=repr)
    assert all(repr(ast.literal_eval(x)) == x for x in lines if x.isascii())
    assert sorted(map(tuple, tables.read_legacy_text(spark, path, df.schema).collect()), key=repr) == sorted(rows, key=repr)


def test_broken_reprs_are_rejected_with_their_text(spark):
    import pytest
    bad = ["{'name': 'O'Brien', 'n': 1}", "{'name': 'in', 'n': {'x': '}'}}", "{'name': ['l'], 'n': 1}", "{'name': 'cut off", "{'name' 'x'}", "{'name': 'x', 'n': 'text'}",
           "{'name': 'x', 'n': 1.5}", "{'name': 'x',, 'n': 1}", "{name: 'x'}", "{'name': 'x', 'n': True}", "no record", "{'name': 'd', 'n': Decimal('1')}"]
    path = fresh_path(spark, "legacy-raw")
    os.makedirs(path)
    with open(os.path.join(path, "a.txt"), "w") as f:
        f.write("\n".join(x for b in bad for x in ("{'name': 'fine', 'n': 2}", b)))
    schema = spark.createDataFrame([], "name string, n int").schema
    with pytest.raises(Exception, match="not a record"):
        tables.read_legacy_text(spark, path, schema).collect()
    got = tables.read_legacy_text(spark, path, schema, corrupt="bad").collect()
    assert [tuple(r) for r in got if r.bad is None] == [("fine", 2, None)] * len(bad)
    assert sorted(r.bad for r in got if r.bad is not None) == sorted(bad) and all(r.name is None and r.n is None for r in got if r.bad)


def test_a_retried_batch_writes_the_same_keys(spark):
    import json
    path = fresh_path(spark, "keyed")
    os.makedirs(path)

    def put(batch):
        for key, row in batch:
            with open(os.path.join(path, key), "w") as f:
                f.write(json.dumps(row, default=str))
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "key string, v int")
    for _ in range(2):
        tables.write_keyed_batches(df, "key", put, batch_size=2)
    assert len(os.listdir(path)) == 3


def test_trips_are_computed_once(spark):
    """With dates and rejects: every input row is read once, and the counters are those of that run."""
    from flotilla.plans.studies import trip_job
    rows = positions(spark, SF_SMALL, "2024-01-05", "2024-01-20")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    out, bad, metrics = fresh_path(spark, "once"), fresh_path(spark, "once-bad"), {}
    holes = rows.withColumn("geo", F.when(F.col("event_id") % 7 != 0, F.col("geo"))).mapInArrow(count, rows.schema).coalesce(2)
    n = rows.count()
    trip_job(holes, out, metrics=metrics, dates=("2024-01-05", "2024-01-20"), rejects_path=bad)
    good, rejected = (spark.read.parquet(p).count() for p in (out, bad))
    assert metrics["rows_in"] == n and metrics["trips"] == good + rejected and rejected > 0
    once = seen.value
    seen.value = 0
    extract_trips(holes, with_date=True).write.format("noop").mode("overwrite").save()
    assert once == seen.value  # as often as computing the trips takes, the sinks add nothing
