"""Last seen row of every vehicle, one table per day up to which positions were paired.

The trips job of the next range starts from it: unlike the plate state (the
first row of the current position, by plate) it holds the newest row, by
vehicle. A table is only valid for the range that begins the day after it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def path_of(base: str, until: str) -> str:
    return os.path.join(base, "last_seen", f"until={until}")


def write(rows: DataFrame, base: str, until: str) -> None:
    """Replace the table of ``until`` (a rerun writes the same rows)."""
    rows.write.mode("overwrite").parquet(path_of(base, until))


def read(spark: SparkSession, base: str, until: str) -> DataFrame:
    """The table of exactly that day; an older one would miss rows and a newer
    one would hide them, so there is no other choice."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path_of(base, until))
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(f"no last-seen table of {until} under {base}: run the days before first, or leave --state out")
    return spark.read.parquet(path_of(base, until))
