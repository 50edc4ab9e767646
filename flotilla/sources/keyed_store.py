"""Keyed document store as a data source: batches of documents, visible on commit.

    spark.dataSource.register(KeyedStore)
    df.write.format("keyed_store").option("key", "matricula").mode("append").save(path)
    stream.writeStream.format("keyed_store").option("key", ...).option("path", path)

Every task writes its rows as files of at most ``batch`` documents under a name of
its own attempt. Files count once the driver has named them in a commit, so what a
failed attempt, a lost executor or an aborted job leaves is never read; an attempt
that is told of its failure removes its files. A micro-batch's commit is named after
the batch: repeating the batch replaces it.

A document is its row as JSON. A row without a key gets a digest of its values, so
equal rows without a key are one document. Of a key written by several commits the
newest counts, of several rows in one commit the last in the order of their JSON text:
the result doesn't depend on how rows are spread over tasks.

    <path>/documents/<attempt>-<n>.parquet     (key, document)
    <path>/commits/<number>.json               {"files": [...]}; <number>: 20 digits

One writer at a time. Mode ``overwrite`` empties the store when it commits.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from flotilla.sources import files

#: Fixed value: rows per write of the keyed batch writer.
BATCH = 400
DOCUMENT = pa.schema([("key", pa.string()), ("document", pa.string())])


@dataclass
class Written(WriterCommitMessage):
    """Files of one task attempt."""
    files: list[str] = field(default_factory=list)


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def document_of(row, key: str) -> tuple[str, str]:
    """(key, document) of a row."""
    values = row.asDict(recursive=True)
    text = json.dumps(values, sort_keys=True, default=str, ensure_ascii=False)
    own = values.get(key)
    return (str(own) if own is not None else hashlib.sha1(text.encode()).hexdigest()), text


class _Writer:
    def __init__(self, options: dict, overwrite: bool = False):
        if "path" not in options or "key" not in options:
            raise ValueError("keyed_store needs a path and the option key")
        self.path, self.key, self.batch = options["path"].rstrip("/"), options["key"], int(options.get("batch", BATCH))
        self.overwrite = overwrite

    def write(self, iterator: Iterator) -> Written:
        fs, root = _system(self.path)
        fs.create_dir(f"{root}/documents", recursive=True)
        attempt, done, rows = uuid.uuid4().hex, Written(), []

        def flush() -> None:
            name = f"{attempt}-{len(done.files):06d}.parquet"
            done.files.append(name)
            pq.write_table(pa.Table.from_pylist([{"key": k, "document": d} for k, d in rows], DOCUMENT), f"{root}/documents/{name}", filesystem=fs)
            rows.clear()

        try:
            for row in iterator:
                rows.append(document_of(row, self.key))
                if len(rows) >= self.batch:
                    flush()
            if rows:
                flush()
        except BaseException:
            self._remove(done.files)
            raise
        return done

    def _remove(self, names: list[str]) -> None:
        fs, root = _system(self.path)
        for name in names:
            if fs.get_file_info(f"{root}/documents/{name}").type != pafs.FileType.NotFound:
                fs.delete_file(f"{root}/documents/{name}")

    def _commit(self, messages: list[Written | None], number: int | None = None) -> None:
        """The commit is one file that appears whole (written beside, then moved)."""
        fs, root = _system(self.path)
        fs.create_dir(f"{root}/commits", recursive=True)
        have = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(f"{root}/commits")) if f.path.endswith(".json"))
        if number is None:
            number = int(have[-1].rsplit("/", 1)[1].split(".")[0]) + 1 if have else 0
        names = [n for m in messages if m is not None for n in m.files]
        target = f"{root}/commits/{number:020d}.json"
        with fs.open_output_stream(target + ".tmp") as f:
            f.write(json.dumps({"files": names, "first": self.overwrite}).encode())
        fs.move(target + ".tmp", target)

    def _abort(self, messages: list[Written | None]) -> None:
        self._remove([n for m in messages if m is not None for n in m.files])


class KeyedWriter(_Writer, DataSourceWriter):
    def commit(self, messages: list[Written | None]) -> None:
        self._commit(messages)

    def abort(self, messages: list[Written | None]) -> None:
        self._abort(messages)


class KeyedStreamWriter(_Writer, DataSourceStreamWriter):
    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self._commit(messages, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._abort(messages)


class KeyedStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyed_store"

    def writer(self, schema: StructType, overwrite: bool) -> KeyedWriter:
        return KeyedWriter(dict(self.options), overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> KeyedStreamWriter:
        return KeyedStreamWriter(dict(self.options))


def write_documents(df: DataFrame, path: str, key: str, batch: int = BATCH, mode: str = "append") -> None:
    """Upsert the rows of ``df`` as documents, in one commit."""
    df.sparkSession.dataSource.register(KeyedStore)
    df.write.format("keyed_store").option("key", key).option("batch", str(batch)).mode(mode).save(path)


def read_documents(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The newest document of every key: (key, document), the document parsed to a
    struct if a schema is given. The list of committed files stays a table."""
    folder = f"{path.rstrip('/')}/commits"
    empty = spark.createDataFrame([], "key string, document string")
    if files.names(spark, folder):
        commits = spark.read.schema("files array<string>, first boolean").json(f"{folder}/*.json").select("files", "first", _name().alias("commit"))
        start = commits.where("first").agg(F.max("commit").alias("_start"))   # one row
        live = commits.join(F.broadcast(start), F.col("_start").isNull() | (F.col("commit") >= F.col("_start")))
        live = live.select(F.explode("files").alias("file"), "commit")
        if not live.isEmpty():
            stored = spark.read.schema("key string, document string").parquet(f"{path.rstrip('/')}/documents").select("*", _name().alias("file"))
            empty = (stored.join(live, "file").groupBy("key")
                     .agg(F.max_by("document", F.struct("commit", "document")).alias("document")))
    if schema is None:
        return empty
    return empty.select("key", F.from_json("document", schema).alias("document"))


def _name() -> Column:
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
