"""Exact top-k by inner product with KD-trees per shard.

Rows are dealt to shards of a bounded size by place: the widest components are
cut at their medians (one aggregate over the table), a cell with more rows than a
shard takes is dealt on by a hash. Each shard's task builds a KD-tree (median splits
on the widest side, tight bounding boxes), writes it to the shared folder, and its
root box to a manifest. Queries come in blocks of one cell; a block's task goes
through the manifest, the trees with the largest bound first, and loads a tree
only if its root box can beat the k-th score of one of its queries; such queries search
it together, best first by the largest inner product a box allows. The k-th scores are carried
from tree to tree. Nothing grows in a task but one shard, one block and a piece of the
manifest, and every task can be run again.

The result doesn't depend on where the cuts are. How much they save depends on the
vectors: where all directions are equally wide, every box allows more than the k-th score
and all trees are searched.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.dataset as pads
from pyspark.sql import Column, DataFrame, functions as F

from flotilla.llm.shared import attempt_name, filesystem, open_output, read_bytes
from flotilla.session import cut_lineage, fresh_path

LEAF = 128
#: Components by which rows are dealt to cells, at most.
CELL_BITS = 12
#: Root boxes that a task holds at once.
MANIFEST_ROWS = 4096


@dataclass
class Tree:
    ids: np.ndarray      # in leaf order
    points: np.ndarray   # integers, in leaf order
    lo: np.ndarray       # tight boxes of the nodes
    hi: np.ndarray
    begin: np.ndarray    # rows of the nodes
    end: np.ndarray
    left: np.ndarray     # first child; the second follows it; -1: a leaf

    def save(self, uri: str) -> None:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        with open_output(uri) as f:
            f.write(out.getbuffer())

    @staticmethod
    def load(uri: str) -> Tree:
        with np.load(io.BytesIO(read_bytes(uri))) as z:
            return Tree(**{k: z[k] for k in z.files})


def build(ids: np.ndarray, points: np.ndarray) -> Tree:
    """Median splits: equal halves of the rows along the widest side of the box,
    also where many points are equal."""
    order = np.argsort(ids, kind="stable")
    lo, hi, begin, end, left = [], [], [0], [len(ids)], [-1]
    node = 0
    while node < len(begin):
        a, b = begin[node], end[node]
        rows = points[order[a:b]]
        lo.append(rows.min(axis=0))
        hi.append(rows.max(axis=0))
        if b - a > LEAF and (lo[-1] < hi[-1]).any():
            side = int(np.argmax(hi[-1].astype(np.float64) - lo[-1]))
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(rows[:, side], mid)]
            left[node] = len(begin)
            begin += [a, a + mid]
            end += [a + mid, b]
            left += [-1, -1]
        node += 1
    span = max(1, int(np.abs(points).max(initial=0)))
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if span <= np.iinfo(t).max)
    return Tree(ids[order], points[order].astype(kind), np.array(lo, kind), np.array(hi, kind), np.array(begin), np.array(end), np.array(left))


def _exact(queries: np.ndarray, tree: Tree):
    """The number type in which all inner products are exact."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(tree.points.astype(np.float64)).max(initial=0)) * queries.shape[1]
    return np.float64 if largest < 2 ** 53 else np.int64


class Best:
    """The k best of one query so far; ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.score, self.id = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def kth(self) -> float:
        return self.score[-1] if len(self.score) == self.k else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        top = np.lexsort((ids, -score))[:self.k]
        self.score, self.id = score[top], ids[top]


def search(tree: Tree, queries: np.ndarray, own: np.ndarray, best: list[Best]) -> int:
    """Best-first search of one tree for a block of queries; returns the leaves visited.

    Nodes are taken by the largest inner product their box allows any query of the
    block; a node concerns those queries alone whose k-th score it can still beat."""
    kind = _exact(queries, tree)
    q, points = queries.astype(kind), tree.points.astype(kind)
    # The largest inner product in each node's box, for all queries at once.
    bound = np.maximum(q, 0) @ tree.hi.astype(kind).T + np.minimum(q, 0) @ tree.lo.astype(kind).T
    left, begin, end, highest = tree.left.tolist(), tree.begin.tolist(), tree.end.tolist(), bound.max(axis=0).tolist()
    kth = np.array([b.kth for b in best], np.float64)
    heap, visited = [(-highest[0], 0)], 0
    while heap:
        top, node = heapq.heappop(heap)
        if -top < kth.min():
            break
        able = np.flatnonzero(bound[:, node] >= kth)  # an equal bound may hold an equal score with a smaller id
        if not len(able):
            continue
        child = left[node]
        if child >= 0:
            for c in (child, child + 1):
                heapq.heappush(heap, (-highest[c], c))
            continue
        visited += 1
        at = slice(begin[node], end[node])
        score, ids = q[able] @ points[at].T, tree.ids[at]
        good = (score >= kth[able, None]) & (ids != own[able, None])
        for j in np.flatnonzero(good.any(axis=1)).tolist():
            i = able[j]
            best[i].add(score[j, good[j]].astype(np.int64), ids[good[j]])
            kth[i] = best[i].kth
    return visited


def integer_vectors(vec: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component, x as double; null if the vector or a
    component is null or a component isn't finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vec.isNotNull() & ~bad, F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "id", vec_col: str = "vec",
          shard_rows: int = 8192, block_rows: int = 128) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest inner products.

    Both inputs have an integer id and an array of integers. Queries look at
    all rows but those with their own id. Ties go to the smaller id; a row that
    is repeated is found as often. Rows without an id or a vector take no part
    (nulls inside a vector: leave them out before). Vectors of different
    lengths don't meet; empty vectors score 0. Other columns are left out, whatever their names. A query with fewer than ``k``
    partners returns all of them. Inner products must fit a long.
    """
    spark = rows.sparkSession
    folder = fresh_path(spark, "kd-trees")

    def narrow(df: DataFrame) -> DataFrame:
        return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("vec")).filter("id IS NOT NULL AND vec IS NOT NULL")

    rows, queries = narrow(rows).withColumn("dim", F.size("vec")), narrow(queries).withColumn("dim", F.size("vec"))
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    cell = _cell(rows, shards)

    def plant(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf.dim.iloc[0])
        tree = build(pdf.id.to_numpy(np.int64), np.array(pdf.vec.tolist(), np.int64).reshape(len(pdf), dim))
        name = attempt_name(folder, f"tree-{dim}", ".npz")
        tree.save(name)
        return pd.DataFrame({"dim": [dim], "file": [name], "lo": [tree.lo[0].astype(np.int64)], "hi": [tree.hi[0].astype(np.int64)]})

    trees = fresh_path(spark, "kd-manifest")
    # As many partitions as groups: every shard and every block may be a task.
    (_dealt(rows.withColumn("cell", cell), shard_rows).repartition(2 * shards, "dim", "cell", "part").groupBy("dim", "cell", "part")
     .applyInPandas(plant, "dim int, file string, lo array<long>, hi array<long>").write.parquet(trees))

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        own, q, best = _search_all(pdf, trees, k)
        return pd.DataFrame([(int(own[i]), r + 1, int(b.id[r]), int(b.score[r])) for i, b in enumerate(best) for r in range(len(b.id))],
                            columns=["query_id", "rank", "vec_id", "score"]).astype({"query_id": "int64", "rank": "int32", "vec_id": "int64", "score": "int64"})

    blocks = max(1, -(-queries.count() // block_rows))
    placed = cut_lineage(queries.withColumn("cell", cell), "kd-queries")
    return (_dealt(placed, block_rows).repartition(2 * blocks, "dim", "cell", "part").groupBy("dim", "cell", "part")
            .applyInPandas(answer, "query_id long, rank int, vec_id long, score long"))


def _cell(rows: DataFrame, shards: int) -> Column:
    """On which side of their medians the widest components lie, one bit each."""
    bits = min(CELL_BITS, (shards - 1).bit_length())
    if not bits:
        return F.lit(0)
    each = rows.select(F.posexplode("vec").alias("at", "x")).groupBy("at").agg(F.var_pop("x").alias("wide"), F.percentile_approx("x", 0.5).alias("median"))
    widest = each.orderBy(F.desc("wide"), "at").limit(bits).collect()  # at most CELL_BITS rows
    parts = [F.when(F.get("vec", F.lit(r["at"])) > F.lit(r.median), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(widest)]
    return sum(parts, F.lit(0))


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with ``part``: those of a cell in parts of about ``size`` rows."""
    parts = rows.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("parts"))
    return rows.join(parts, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("id", "vec"), "parts")).drop("parts")


def _search_all(pdf: pd.DataFrame, trees: str, k: int, load: Callable[[str], Tree] = Tree.load) -> tuple[np.ndarray, np.ndarray, list[Best]]:
    """(ids, vectors, best) of a block of queries, over all trees of the manifest."""
    dim = int(pdf.dim.iloc[0])
    own, q = pdf.id.to_numpy(np.int64), np.array(pdf.vec.tolist(), np.int64).reshape(len(pdf), dim)
    best, wide = [Best(k) for _ in own], q.astype(np.float64)
    fs, path = filesystem(trees)
    for piece in pads.dataset(path, format="parquet", filesystem=fs).to_batches(filter=pads.field("dim") == dim, batch_size=MANIFEST_ROWS):
        files = piece.column("file").to_pylist()
        lo, hi = (np.array(piece.column(c).to_pylist(), np.float64).reshape(len(files), dim) for c in ("lo", "hi"))
        # No less than the largest inner product in the box: rounding is allowed for.
        bound = np.maximum(wide, 0) @ hi.T + np.minimum(wide, 0) @ lo.T + 1e-12 * (np.abs(wide) @ np.maximum(np.abs(lo), np.abs(hi)).T)
        for t in np.argsort(-bound.max(axis=0), kind="stable").tolist():
            able = np.flatnonzero(bound[:, t] >= np.array([b.kth for b in best]))
            if len(able):
                search(load(files[t]), q[able], own[able], [best[i] for i in able])
    return own, q, best
