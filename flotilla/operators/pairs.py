"""Adjacent-row pairing and row numbering of vehicle positions.

The reference numbers every position in one global order and self-joins
row *k* with row *k-1*. Here the previous row is attached directly, in one
pass over the data, with no single-task window:

* a vehicle with at most ``hot_rows`` rows is one window group;
* the rows of vehicles with more are sorted into ranges of about ``hot_rows``
  rows by (vehicle, *order*), the whole tie-break tuple included, so neither a
  vehicle that holds most of the table nor a flood of copies at one timestamp
  makes a large group. The ranges are written once with their ids, for these
  vehicles only. There is no list of hot values and nothing is broadcast by
  hint;
* the last row of every group (``max_by``, partially aggregated before the
  shuffle) gives a one-row-per-group summary; the previous group's last row is
  found on that summary (per vehicle, or in the global order with
  :mod:`flotilla.operators.ordered`);
* that row is injected as a *carry-in* row at the head of the next group,
  so a plain ``lag`` inside each group yields the previous row everywhere.

Row numbers use the same shape with counts instead of last rows. Rows that
are equal in the whole order (repeated rows) keep an arbitrary but single order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flotilla.operators.ordered import fixed_ranges, lag_in_global_order, offset_in_global_order

# A vehicle with more rows than this is split into ranges of about this many;
# others are paired in one window group (one task sorts at most this many rows).
DEFAULT_HOT_ROWS = 200_000
# The order of a vehicle's positions; columns a table doesn't have are left out.
DEFAULT_ORDER = ("epochTime", "realTime", "uoid", "event_id")


def order_in(df: DataFrame, order: Sequence[str] = DEFAULT_ORDER) -> list[str]:
    """The columns of ``order`` that ``df`` has."""
    return [c for c in order if c in df.columns]


def hot_entities(df: DataFrame, entity: str, hot_rows: int) -> DataFrame:
    """Entities holding more than ``hot_rows`` rows, with their number of rows: a
    one-column scan with map-side counts."""
    return (df.groupBy(F.col(entity).alias("_hot_ent")).agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > F.lit(hot_rows)))


def _bucketed(df: DataFrame, entity: str, keep: Sequence[str], hot_rows: int | None,
              order: Sequence[str], n_ranges: int | None = None) -> tuple[DataFrame, bool]:
    """((_ent, _b, _row), split).

    ``_b`` is NULL (one group) for vehicles of at most ``hot_rows`` rows and the
    id of the row's range for the others (for all with ``hot_rows=None``); it
    grows with the order within a vehicle. ``split`` is False when no vehicle
    is split.
    """
    base = df.select(F.col(entity).alias("_ent"), F.struct(*[F.col(x) for x in keep]).alias("_row"))
    by = ["_ent", *[F.col(f"_row.{c}") for c in order]]
    if hot_rows is None:
        return fixed_ranges(base, by, n_ranges, "_b").select("_ent", F.col("_b").cast("bigint").alias("_b"), "_row"), True
    hot = hot_entities(df, entity, hot_rows)
    total = hot.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    none = F.lit(None).cast("bigint").alias("_b")
    if total == 0:
        return base.select("_ent", none, "_row"), False
    hot = hot.select("_hot_ent")
    same = F.col("_ent").eqNullSafe(F.col("_hot_ent"))
    n = n_ranges or -(-total // max(1, hot_rows))
    ranged = fixed_ranges(base.join(hot, same, "left_semi"), by, int(n), "_b")
    cold = base.join(hot, same, "left_anti").select("_ent", none, "_row")
    return cold.unionByName(ranged.select("_ent", F.col("_b").cast("bigint").alias("_b"), "_row")), True


def _row_key(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"_row.{c}") for c in order])


def _bucket_window(order: Sequence[str]):
    return Window.partitionBy("_ent", "_b").orderBy(
        F.col("_carry").desc(), *[F.col(f"_row.{c}").asc_nulls_first() for c in order])


def previous_in_groups(df: DataFrame, entity: str, order: Sequence[str], prev_col: str = "prev") -> DataFrame:
    """``prev_col`` with one window group per entity, however large: one exchange, or
    none where the rows are stored by ``entity``."""
    row = F.struct(*[F.col(c) for c in df.columns])
    w = Window.partitionBy(entity).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn(prev_col, F.lag(row).over(w))


def attach_previous(df: DataFrame, entity: str = "idVehiculo",
                    order: Sequence[str] = DEFAULT_ORDER,
                    scope: str = "vehicle", prev_col: str = "prev",
                    hot_rows: int | None = DEFAULT_HOT_ROWS,
                    n_ranges: int | None = None) -> DataFrame:
    """All columns of ``df`` plus ``prev_col``: the previous row as a struct.

    scope='vehicle': previous row of the same ``entity`` in ``order``
    (NULL for a vehicle's first row). scope='global': previous row in the
    order (entity NULLS FIRST, *order*), across vehicle borders -- the
    reference's single global numbering.

    Vehicles above ``hot_rows`` rows are split into ranges; ``hot_rows=None``
    splits every vehicle.
    """
    if scope not in ("vehicle", "global"):
        raise ValueError(f"scope must be 'vehicle' or 'global', not {scope!r}")
    order = order_in(df, order)
    base, split = _bucketed(df, entity, df.columns, hot_rows, order, n_ranges)
    if scope == "vehicle" and not split:
        # No hot vehicle: one window group per vehicle, one exchange.
        w = Window.partitionBy("_ent").orderBy(*[F.col(f"_row.{c}").asc_nulls_first() for c in order])
        return base.withColumn(prev_col, F.lag("_row").over(w)).select("_row.*", prev_col)
    if scope == "vehicle":
        # Only split vehicles need carry-in rows: the last row of the
        # previous non-empty bucket (partial aggregation before the shuffle).
        tails = (base.where(F.col("_b").isNotNull())
                     .groupBy("_ent", "_b").agg(F.max_by("_row", _row_key(order)).alias("_tail")))
        carry = tails.select("_ent", "_b", F.lag("_tail").over(
            Window.partitionBy("_ent").orderBy("_b")).alias("_in"))
    else:
        # Every group needs the last row of the group before it in the
        # global order, found on the one-row-per-group summary.
        tails = base.groupBy("_ent", "_b").agg(F.max_by("_row", _row_key(order)).alias("_tail"))
        carry = lag_in_global_order(tails, ["_ent", "_b"], "_tail", "_in", n_ranges)
    carry = carry.where(F.col("_in").isNotNull()).select(
        "_ent", "_b", F.lit(True).alias("_carry"), F.col("_in").alias("_row"))
    rows = base.select("_ent", "_b", F.lit(False).alias("_carry"), "_row")
    return (rows.unionByName(carry)
                .withColumn(prev_col, F.lag("_row").over(_bucket_window(order)))
                .where(~F.col("_carry"))
                .select("_row.*", prev_col))


def row_numbers(df: DataFrame, entity: str = "idVehiculo",
                order: Sequence[str] = DEFAULT_ORDER,
                scope: str = "global", out: str = "tempField",
                hot_rows: int | None = DEFAULT_HOT_ROWS,
                n_ranges: int | None = None) -> DataFrame:
    """``ROW_NUMBER()`` over (entity NULLS FIRST, *order*) globally, or per entity.

    Counts per group (vehicle, or range of a split vehicle) are
    prefix-summed on the summary; each group's offset enters its partition
    as a carry-in row, so the numbers come from a running sum inside it.
    """
    order = order_in(df, order)
    base, split = _bucketed(df, entity, df.columns, hot_rows, order, n_ranges)
    if scope == "vehicle" and not split:
        w = Window.partitionBy("_ent").orderBy(*[F.col(f"_row.{c}").asc_nulls_first() for c in order])
        return base.withColumn(out, F.row_number().over(w).cast("bigint")).select("_row.*", out)
    if scope == "global":
        counts = base.groupBy("_ent", "_b").agg(F.count(F.lit(1)).alias("_n"))
        offs = offset_in_global_order(counts, ["_ent", "_b"], "_n", "_off", n_ranges)
    elif scope == "vehicle":
        counts = base.where(F.col("_b").isNotNull()).groupBy("_ent", "_b") \
                     .agg(F.count(F.lit(1)).alias("_n"))
        offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
            Window.partitionBy("_ent").orderBy("_b")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    else:
        raise ValueError(f"scope must be 'vehicle' or 'global', not {scope!r}")
    null_row = F.lit(None).cast(base.schema["_row"].dataType)
    carry = offs.select("_ent", "_b", F.lit(True).alias("_carry"), null_row.alias("_row"),
                        F.col("_off").cast("bigint").alias("_w"))
    rows = base.select("_ent", "_b", F.lit(False).alias("_carry"), "_row", F.lit(1).cast("bigint").alias("_w"))
    w = _bucket_window(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.unionByName(carry)
                .withColumn(out, F.sum("_w").over(w))
                .where(~F.col("_carry"))
                .select("_row.*", out))


def union_shift(df: DataFrame, rn: str = "tempField", **kw) -> DataFrame:
    """The reference's pairing input: rows numbered *k* (k > 1) UNION ALL the
    same rows numbered *k+1*; key *k* then holds rows *k-1* and *k*."""
    numbered = row_numbers(df, out=rn, **kw)
    return numbered.where(F.col(rn) != 1).unionByName(
        numbered.withColumn(rn, F.col(rn) + 1))


def pairs_by_group(shifted: DataFrame, rn: str = "tempField",
                   order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """GroupByKey on the shifted numbering: rows per key, ordered explicitly
    (a grouped list has no order; here start = the earlier row). Each key holds at
    most two rows, so the groups are bounded."""
    key = F.struct(*[F.col(c) for c in order_in(shifted, order)])
    return shifted.groupBy(rn).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min_by("event_id", key).alias("start_event_id"),
        F.max_by("event_id", key).alias("end_event_id"),
    )
