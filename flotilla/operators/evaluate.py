"""Reproducible splits, CV folds, error columns and error tables.

Splits and folds come from a hash of a row key, not from ``randomSplit``:
the assignment is the same on every run, every partitioning and in SQL
(``md5`` -> first 8 hex digits -> integer -> mod 100 / mod k).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hold-out share of train_test_split's default (25 %).
TRAIN_PERCENT = 75
# Repeated K-fold CV of the study (10 folds x 3 repeats).
CV_FOLDS, CV_REPEATS = 10, 3
# Default histogram bins (pandas hist) and the fine variant.
HIST_BINS, HIST_BINS_FINE = 10, 400


def row_key(cols: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def hash_bucket(key: Column, modulo: int) -> Column:
    """Integer of the first 8 hex digits of md5(key), mod ``modulo``."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(modulo))


def with_split(df: DataFrame, key_cols: Sequence[str], train_percent: int = TRAIN_PERCENT,
               out: str = "is_train") -> DataFrame:
    return df.withColumn(out, hash_bucket(row_key(key_cols), 100) < F.lit(train_percent))


def with_folds(df: DataFrame, key_cols: Sequence[str], folds: int = CV_FOLDS,
               repeat: int = 0, out: str = "fold") -> DataFrame:
    key = F.concat(F.lit(f"{repeat}|"), row_key(key_cols))
    return df.withColumn(out, hash_bucket(key, folds))


def errors(df: DataFrame, real: str = "Real", pred: str = "Prediction",
           available: str | None = "numAvailable") -> DataFrame:
    """Err = Real - Prediction; ErrPorcentage = |Err| / numAvailable."""
    out = df.withColumn("Err", F.col(real).cast("double") - F.col(pred).cast("double"))
    if available:
        out = out.withColumn("ErrPorcentage",
                             F.try_divide(F.abs(F.col("Err")), F.col(available).cast("double")))
    return out


def round_half_even(c: Column) -> Column:
    """numpy's ``round(0)``: half to even (0.5 -> 0, 1.5 -> 2, 2.5 -> 2)."""
    return F.bround(c, 0)


def mean_by(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``groupby(key).mean()[cols]``."""
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])


def histogram(df: DataFrame, col: str, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histogram like numpy: rows (bin, lo, hi, n) for bins 1..bins.

    Range = [min, max]; the last bin is closed on the right; an all-equal
    column uses [v - 0.5, v + 0.5]. Two passes: min and max come from one
    global aggregate (map-side partials, two numbers reach the driver and
    enter the plan as literals), then the counts per bin; empty bins come
    from the bin ids.
    """
    # NULL and NaN are left out (NaN sorts above every number in Spark and
    # would become the maximum; numpy refuses such a range).
    vals = df.select(F.col(col).cast("double").alias("v")) \
             .where(F.col("v").isNotNull() & ~F.isnan("v"))
    mn, mx = vals.agg(F.min("v"), F.max("v")).first()
    ids = df.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    if mn is None:
        return ids.select("bin", F.lit(None).cast("double").alias("lo"),
                          F.lit(None).cast("double").alias("hi"), F.lit(0).cast("bigint").alias("n")) \
                  .where(F.lit(False))
    lo0, hi0 = (mn - 0.5, mx + 0.5) if mn == mx else (mn, mx)
    width = (hi0 - lo0) / bins
    idx = F.floor((F.col("v") - F.lit(lo0)) / F.lit(hi0 - lo0) * F.lit(bins)).cast("bigint") + 1
    counts = vals.select(F.least(idx, F.lit(bins).cast("bigint")).alias("bin")) \
                 .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return (ids.join(counts, "bin", "left")
               .select("bin", (F.lit(lo0) + (F.col("bin") - 1) * F.lit(width)).alias("lo"),
                       (F.lit(lo0) + F.col("bin") * F.lit(width)).alias("hi"),
                       F.coalesce(F.col("n"), F.lit(0)).alias("n")))
