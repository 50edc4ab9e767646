"""Folders on whatever file system Hadoop knows by their path."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def path_and_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    root, fs = path_and_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def complete(spark: SparkSession, folder: str) -> list[str]:
    """The tables of a folder that were written to the end."""
    out = []
    for name in names(spark, folder):
        mark, fs = path_and_system(spark, os.path.join(folder, name, "_SUCCESS"))
        if fs.exists(mark):
            out.append(name)
    return out


def delete(spark: SparkSession, path: str) -> None:
    p, fs = path_and_system(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = path_and_system(spark, path)
    fs.mkdirs(p)
