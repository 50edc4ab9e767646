"""Order-dependent steps over a *global* sort order, without a single task.

A window with no ``partitionBy`` moves every row into one task. These helpers
compute the same results with a range-partitioned sort instead:

1. ``repartitionByRange(n, order)`` splits the rows into ``n`` contiguous,
   ordered ranges (a sampled, distributed sort), and the rows are written to
   the shared folder with their range id. Range bounds are sampled anew by
   every exchange, so an id that is used twice has to be fixed once.
2. The window runs per range (``partitionBy(range id)``).
3. Each range's boundary value (last row / total) forms a table of one row
   per range; its own prefix is computed there and joined back (Spark sizes
   that join; nothing is hinted).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flotilla.session import cut_lineage

_RID = "_range_id"


def fixed_ranges(df: DataFrame, order: list, n: int | None = None, out: str = _RID) -> DataFrame:
    """``df`` with the id of its range in ``order`` (columns, nulls first), read
    back from the shared folder, so that every use sees the same ids."""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [(F.col(c) if isinstance(c, str) else c).asc_nulls_first() for c in order]
    return cut_lineage(df.repartitionByRange(n, *by).withColumn(out, F.spark_partition_id()), "ranges")


def lag_in_global_order(df: DataFrame, order: list[str], value: str, out: str,
                        n_ranges: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = ``value`` of the previous row in ``order``."""
    r = fixed_ranges(df, order, n_ranges)
    key = F.struct(*[F.col(c) for c in order])
    w = Window.partitionBy(_RID).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    r = r.withColumn(out, F.lag(value).over(w)).withColumn("_first_in_range", F.row_number().over(w) == 1)
    # One row per non-empty range: its last value; then the previous range's.
    tails = r.groupBy(_RID).agg(F.max_by(F.col(value), key).alias("_range_tail"))
    prev_tail = tails.select(
        _RID, F.lag("_range_tail").over(Window.orderBy(_RID)).alias("_prev_range_tail"))
    out_col: Column = F.when(F.col("_first_in_range"), F.col("_prev_range_tail")).otherwise(F.col(out))
    return (r.join(prev_tail, _RID, "left")
             .withColumn(out, out_col)
             .drop(_RID, "_first_in_range", "_prev_range_tail"))


def offset_in_global_order(df: DataFrame, order: list[str], weight: str, out: str,
                           n_ranges: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = sum of ``weight`` over all rows before it in ``order``."""
    r = fixed_ranges(df, order, n_ranges)
    w = (Window.partitionBy(_RID).orderBy(*[F.col(c).asc_nulls_first() for c in order])
         .rowsBetween(Window.unboundedPreceding, -1))
    r = r.withColumn("_local", F.coalesce(F.sum(weight).over(w), F.lit(0)))
    totals = r.groupBy(_RID).agg(F.sum(weight).alias("_range_total"))
    before = totals.select(
        _RID,
        F.coalesce(F.sum("_range_total").over(
            Window.orderBy(_RID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_range_offset"))
    return (r.join(before, _RID, "left")
             .withColumn(out, F.col("_range_offset") + F.col("_local"))
             .drop(_RID, "_local", "_range_offset"))
