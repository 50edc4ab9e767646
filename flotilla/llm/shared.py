"""Files in the shared folder, written and read by tasks, and row helpers.

Tasks open files through ``pyarrow.fs`` so the shared folder may be local,
HDFS or an object store. A task writes under a name of its own attempt and
returns that name; only names that reached the manifest are read again, so a
retried or speculative task leaves at most an unread file behind.
"""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flotilla.session import fresh_path


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of ``uri`` (a URI or an absolute path) and the path in it."""
    return pafs.FileSystem.from_uri(uri)


def attempt_name(folder: str, stem: str, suffix: str) -> str:
    """A file name no other task attempt uses."""
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def open_output(uri: str):
    """Output stream for ``uri``; makes its folder."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path, compression=None)


def read_bytes(uri: str) -> bytes:
    fs, path = filesystem(uri)
    with fs.open_input_stream(path, compression=None) as f:
        return f.readall()


class Tables:
    """Intermediate tables of one operator run in the shared folder. Each is
    removed as soon as everything made from it has been written itself, so no
    later job (nor a repeated task of one) can need it again."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back."""
        path = fresh_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def one_task_per_row(manifest: DataFrame) -> DataFrame:
    """Deal a written manifest so that every row (a file) is a task of its own."""
    return manifest.coalesce(1).repartition(max(1, manifest.count()))


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bound what one Arrow batch between Spark and a worker holds. The default of
    64 MB is held several times over (sender, receiver, copies) by every worker;
    whole documents need no such batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that names an operator adds beside
    it can't clash with the input's."""
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns])


def ascii_lower(c: Column) -> Column:
    """``c`` with A-Z lower-cased and nothing else changed."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, upper, upper.lower()))


def held_out(id_col: Column) -> Column:
    """Rows kept from every fit: crc32 of the id as text, modulo 5, is 0. A null
    id counts as held out, so it never enters a fit."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))
