"""The keyed store: documents count once, and only when their commit has."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from flotilla.session import fresh_path
from flotilla.sources import keyed_store as K


def _docs(spark, path):
    return {r.key: json.loads(r.document) for r in K.read_documents(spark, path).collect()}


def test_upsert_by_commits(spark):
    path = fresh_path(spark, "keyed")
    df = spark.range(1050).select(F.concat(F.lit("k"), F.col("id")).alias("id"), F.col("id").alias("v"), F.lit("é\n\"").alias("t"))
    K.write_documents(df.repartition(3), path, "id", batch=100)
    assert _docs(spark, path) == {f"k{i}": {"id": f"k{i}", "v": i, "t": "é\n\""} for i in range(1050)}
    sizes = spark.read.parquet(f"{path}/documents").groupBy(K._name()).count().collect()
    assert max(r["count"] for r in sizes) == 100 and sum(r["count"] for r in sizes) == 1050
    K.write_documents(df.where("v < 5").withColumn("v", F.col("v") + 5000), path, "id")
    got = _docs(spark, path)
    assert len(got) == 1050 and got["k4"]["v"] == 5004 and got["k5"]["v"] == 5
    typed = K.read_documents(spark, path, "id string, v long").select("document.*").where("v = 5004").collect()
    assert typed == [Row(id="k4", v=5004)]
    K.write_documents(df.where("v = 7"), path, "id", mode="overwrite")
    assert list(_docs(spark, path)) == ["k7"]


def test_rows_without_key_and_equal_keys(spark):
    path = fresh_path(spark, "keyed")
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), (None, 5), (None, 5), (None, 6), ("", 9)], "id string, v long")
    for parts in (1, 4):
        K.write_documents(df.repartition(parts), path, "id", mode="overwrite")
        got = _docs(spark, path)
        assert got["a"]["v"] == 3 and got[""]["v"] == 9 and len(got) == 4


def test_attempts_that_fail_leave_nothing(spark, tmp_path):
    """The first attempt breaks off, a second is never committed, a third is."""
    writer = K.KeyedWriter({"path": str(tmp_path), "key": "id", "batch": "2"})
    rows = [Row(id=str(i), v=i) for i in range(7)]

    def breaks():
        yield from rows[:5]
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(breaks())
    assert list((tmp_path / "documents").iterdir()) == []
    lost = writer.write(iter(rows))            # a speculative attempt whose answer nobody took
    good = writer.write(iter(rows))
    assert _docs(spark, str(tmp_path)) == {}   # nothing is visible before the commit
    writer.commit([good, None])
    assert _docs(spark, str(tmp_path)) == {str(i): {"id": str(i), "v": i} for i in range(7)}
    assert len(list((tmp_path / "documents").iterdir())) == 8
    writer.abort([lost, None])
    assert len(list((tmp_path / "documents").iterdir())) == 4 and len(_docs(spark, str(tmp_path))) == 7


def test_a_failing_job_commits_nothing(spark):
    path = fresh_path(spark, "keyed")
    K.write_documents(spark.createDataFrame([("a", 1)], "id string, v long"), path, "id")
    bad = spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("id"), F.expr("if(id = 99, raise_error('x'), id)").cast("long").alias("v"))
    with pytest.raises(Exception):
        K.write_documents(bad, path, "id", batch=10)
    assert _docs(spark, path) == {"a": {"id": "a", "v": 1}}


def test_stream_batches_are_committed_once(spark, tmp_path):
    path, feed = str(tmp_path / "store"), str(tmp_path / "feed")
    spark.dataSource.register(K.KeyedStore)

    def run():
        q = (spark.readStream.schema("id string, v long").parquet(feed).writeStream.format("keyed_store").option("path", path)
             .option("key", "id").option("checkpointLocation", str(tmp_path / "marks")).trigger(availableNow=True).start())
        q.awaitTermination()

    for first in (0, 5):
        spark.range(first, first + 10).selectExpr("cast(id as string) as id", f"id + {first} as v").write.mode("append").parquet(feed)
        run()
    run()
    want = {str(i): {"id": str(i), "v": i + (5 if i >= 5 else 0)} for i in range(15)}
    assert _docs(spark, path) == want
    commits = sorted((tmp_path / "store" / "commits").iterdir())
    # The last micro-batch again, as after a crash between its commit and the query's own mark.
    writer = K.KeyedStreamWriter({"path": path, "key": "id"})
    again = writer.write(iter([Row(id=str(i), v=i + 5) for i in range(5, 15)]))
    writer.commit([again], len(commits) - 1)
    assert _docs(spark, path) == want and sorted((tmp_path / "store" / "commits").iterdir()) == commits


def test_empty_write_and_options(spark):
    path = fresh_path(spark, "keyed")
    K.write_documents(spark.createDataFrame([], "id string, v long"), path, "id")
    assert _docs(spark, path) == {}
    with pytest.raises(ValueError):
        K.KeyedWriter({"path": path})
