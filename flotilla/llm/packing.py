"""Length buckets that minimise padding, and token-budget batches in them.

The histogram of lengths is counted by Spark; a dynamic programme over its
distinct lengths chooses the bucket bounds with the least total padding. The
histogram is what reaches the driver: D distinct lengths need at least
D * (D - 1) / 2 tokens, so D is at most the square root of twice the corpus's
tokens. Rows are numbered inside their bucket in two levels (a window over
bounded salted parts, and each part's offset), so a bucket with most of the
rows is never one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from flotilla.session import cut_lineage


def bucket_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Ascending bounds, the last the largest length, with the least padding
    when every length is padded to the next bound.

    best[k][j] = min over i of best[k-1][i] + bound_j * (C_j - C_i) - (T_j - T_i)
    with C, T the prefix sums of counts and tokens: for each layer the lower
    envelope of lines of falling slope -C_i, asked at rising bounds.
    """
    order = np.argsort(lengths)
    b = [int(lengths[i]) for i in order]
    c = [int(counts[i]) for i in order]
    d = len(b)
    if not d:
        return []
    C, T = [0], [0]
    for x, n in zip(b, c):
        C.append(C[-1] + n)
        T.append(T[-1] + n * x)
    best = [b[j] * C[j + 1] - T[j + 1] for j in range(d)]  # one bucket
    back = []
    for _ in range(1, min(buckets, d)):
        lines: list[tuple[int, int, int]] = []  # slope, intercept, i
        head, layer, from_ = 0, [], np.zeros(d, np.int64)
        for j in range(d):
            if j:  # a bucket may begin after length j - 1
                m, t = -C[j], best[j - 1] + T[j]
                while len(lines) - head >= 2:
                    (m1, t1, _), (m2, t2, _) = lines[-2], lines[-1]
                    if (t - t1) * (m1 - m2) <= (t2 - t1) * (m1 - m):
                        lines.pop()
                    else:
                        break
                lines.append((m, t, j))
                x = b[j]
                while head + 1 < len(lines) and lines[head + 1][0] * x + lines[head + 1][1] <= lines[head][0] * x + lines[head][1]:
                    head += 1
                m, t, i = lines[head]
                split = b[j] * C[j + 1] - T[j + 1] + m * x + t
            if j and split < best[j]:
                layer.append(split)
                from_[j] = i
            else:
                layer.append(best[j])
                from_[j] = -1  # no better than with a bucket fewer
        best = layer
        back.append(from_)
    out, j, k = [b[d - 1]], d - 1, len(back) - 1
    while k >= 0:
        i = int(back[k][j])
        if i >= 0:
            j = i - 1
            out.append(b[j])
        k -= 1
    return out[::-1]


def padding(lengths, counts, bounds) -> int:
    """Padding of a histogram under bounds."""
    at = np.searchsorted(bounds, lengths)
    return int(sum(int(c) * (int(bounds[i]) - int(n)) for n, c, i in zip(lengths, counts, at)))


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def pack(docs: DataFrame, length: Column, id_col: str = "doc_id", buckets: int = 16, token_budget: int = 16_384,
         part_rows: int = 50_000) -> DataFrame:
    """(doc id, n_tokens, bucket_tokens, batch_id, slot), a row per row.

    ``bucket_tokens`` is the length a row is padded to. A batch holds rows of
    one bucket, ``max(1, token_budget // bucket_tokens)`` of them, so padded it
    stays within the budget unless it is a single longer row; only the last of
    a bucket has fewer. ``batch_id`` is unique over buckets, ``slot`` counts
    from 0. ``length`` null counts as 0, and rows of length 0 are packed like
    others. Rows repeated, or without an id, are packed row by row, and dealt to
    parts by their place in the table, so equal ones spread like any others. Texts of
    any length are only counted here. Other columns don't matter; an ``id_col`` that
    has the name of a result column is returned as ``doc_id``. An empty table gives no rows.
    """
    name = "doc_id" if id_col in ("n_tokens", "bucket_tokens", "batch_id", "slot") else id_col
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(length, F.lit(0)).cast("long").alias("n_tokens"), F.monotonically_increasing_id().alias("_row"))
    rows = cut_lineage(rows, "lengths")
    histogram = rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).toArrow()
    lengths, counts = histogram.column(0).to_pylist(), histogram.column(1).to_pylist()
    bounds = bucket_bounds(lengths, counts, buckets)
    parts = max(1, -(-sum(counts) // part_rows))
    array = F.array(*[F.lit(x).cast("long") for x in bounds]) if bounds else F.array(F.lit(0).cast("long"))
    bucketed = (rows.withColumn("_bucket", F.size(F.filter(array, lambda x: x < F.col("n_tokens"))))
                .withColumn("_order", F.xxhash64("_id", "n_tokens", "_row")))
    bucketed = bucketed.withColumn("_part", F.pmod(F.xxhash64(F.col("_order"), F.lit(5)), F.lit(parts)))
    sizes = bucketed.groupBy("_bucket", "_part").agg(F.count(F.lit(1)).alias("_n"))
    # A row per bucket and part of part_rows rows.
    earlier = Window.partitionBy("_bucket").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"), "pack-offsets")
    place = F.row_number().over(Window.partitionBy("_bucket", "_part").orderBy("_order", "_row"))
    numbered = bucketed.withColumn("_place", place).join(offsets, ["_bucket", "_part"])
    bound = F.element_at(array, F.col("_bucket") + 1)
    capacity = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(bound, F.lit(1)))).cast("long")
    at = F.col("_offset") + F.col("_place") - 1
    batch = F.floor(at / capacity).cast("long")
    return numbered.select(F.col("_id").alias(name), "n_tokens", bound.alias("bucket_tokens"),
                           F.concat(F.col("_bucket").cast("string"), F.lit("-"), batch.cast("string")).alias("batch_id"),
                           (at - batch * capacity).cast("int").alias("slot"))
