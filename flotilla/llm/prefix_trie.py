"""The trie of conversation prefixes, screened by a count-min sketch.

A conversation's first d turns are a node. Turns are reduced to digests where
they are scanned; a prefix's digest is the exclusive or of its turns' digests,
each taken with its place, so prefixes are chained with windows over ranges of
turns and a conversation of any length spreads over tasks.

Every prefix digest is counted in a count-min sketch. The sketch never counts
too little, so an estimate of one proves that a prefix has one member: that
node, and all below it, are rows of their own and are written where they are
(their tails never shuffle). Only prefixes that may be shared shuffle, and are
grouped exactly, so a wrong estimate costs work and never a result. The sketch
keeps what the question needs of each counter, one bit: whether it passed one.

The sums over subtrees come from the members: a conversation *owns* the nodes
whose smallest member it is, which are all its nodes from some depth on. Above
that depth its turns repeat another conversation's, so the tokens a node saves
are those that its members have between it and the nodes they own; its leaves
are the members that own a childless end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flotilla.llm.packing import word_count
from flotilla.session import cut_lineage

#: Cells of a sketch page, cells per prefix, and the largest sketch (two rows of 2 ** MOST_BITS cells).
PAGE = 1 << 18
CELLS = 8
MOST_BITS = 28
NODE = ["p1", "p2", "depth"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_digests(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, d1, d2, words, rid): what a trie needs of each turn, written
    to the shared folder. Null role and text are empty; rows without a
    conversation are left out. d1, d2 digest role and text; rid tells rows apart."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    out = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                       F.xxhash64(role, text).alias("d1"), F.xxhash64(F.lit("turn"), role, text).alias("d2"),
                       word_count(text).alias("words"), F.monotonically_increasing_id().alias("rid"))
    return cut_lineage(out.filter("conv_id IS NOT NULL"), "turn-digests")


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("d1"), F.col("d2"), F.col("rid")]


def with_borrowed_heads(turns: DataFrame, lender: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``heads`` turns are replaced by as many of
    conversation ``lender`` (fewer, if that has fewer; none, if it is absent); both
    are expressions of conv_id, heads at most ``most``.

    Returns the turns (those of :func:`turn_digests`, and ``part``, 0 for borrowed
    turns) and all conversations, turnless ones too. Only the first few turns of a
    conversation are ranked, which Spark cuts short before the shuffle.
    """
    first = (turns.select("conv_id", "turn", "d1", "d2", "words", "rid")
             .withColumn("i", F.row_number().over(Window.partitionBy("conv_id").orderBy(*_order()))).filter(F.col("i") <= most))
    first = cut_lineage(first, "heads")
    convs = cut_lineage(turns.select("conv_id").distinct(), "conversations")
    lent = first.select(F.col("conv_id").alias("lender"), "turn", "d1", "d2", "words", "rid", "i")
    asking = convs.select("conv_id", lender.alias("lender"), heads.alias("heads"))
    borrowed = asking.join(lent, "lender").filter(F.col("i") <= F.col("heads"))
    replaced = first.filter(F.col("i") <= heads).select("rid")
    own = turns.join(replaced, "rid", "left_anti")
    cols = ["conv_id", "part", "turn", "d1", "d2", "words", "rid"]
    rows = borrowed.withColumn("part", F.lit(0)).select(*cols).unionByName(own.withColumn("part", F.lit(1)).select(*cols))
    return cut_lineage(rows, "rebuilt"), convs


# ------------------------------------------------------------------ prefixes

def _ranged(rows: DataFrame, order: list[Column], per_range: int, label: str) -> DataFrame:
    """``rows`` with the number of their range in ``order`` (``rg``), written: range
    bounds are sampled, so a number that is used twice must be fixed once."""
    n = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // per_range))
    return cut_lineage(rows.repartitionByRange(n, *order).withColumn("rg", F.spark_partition_id()), label)


def prefixes(rows: DataFrame, per_range: int = 1 << 18) -> DataFrame:
    """(conv_id, depth, p1, p2, q1, q2, words, through, last): a row per prefix of
    each conversation but the empty one. p1, p2 digest the prefix, q1, q2 the one
    before; ``through`` are its words, ``last`` says that the conversation ends here.

    Turns are dealt to ranges of their order. A conversation cut by a range border
    takes up what the ranges before hold of it; at most two conversations a range
    are cut, so those sums are a small table.
    """
    by = [F.col("conv_id"), F.col("part"), *_order()]
    ranged = _ranged(rows, by, per_range, "turn-ranges")
    w = Window.partitionBy("rg", "conv_id").orderBy(F.col("part"), *_order())
    earlier = Window.partitionBy("conv_id").orderBy("rg").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("conv_id").orderBy("rg")
    cut = (ranged.groupBy("conv_id", "rg").agg(F.count("*").alias("n"))
           .select("conv_id", "rg", F.sum("n").over(earlier).alias("before"), F.lead("rg").over(over).isNotNull().alias("goes_on"))
           .filter("before IS NOT NULL OR goes_on"))
    depth = F.row_number().over(w) + F.coalesce("before", F.lit(0))
    local = (ranged.join(F.broadcast(cut), ["conv_id", "rg"], "left")
             .withColumn("depth", depth.cast("long"))
             .withColumn("last", F.lead("rid").over(w).isNull() & ~F.coalesce("goes_on", F.lit(False)))
             .withColumns({"z1": F.xxhash64(F.lit(1), "d1", "d2", "depth"), "z2": F.xxhash64(F.lit(2), "d1", "d2", "depth")})
             .select("conv_id", "rg", "depth", "words", "last", "z1", "z2", (F.col("before").isNotNull() | F.coalesce("goes_on", F.lit(False))).alias("cut"),
                     F.bit_xor("z1").over(w).alias("x1"), F.bit_xor("z2").over(w).alias("x2"), F.sum("words").over(w).alias("sum")))
    local = cut_lineage(local, "prefix-ranges")
    carry = (local.filter("cut").groupBy("conv_id", "rg").agg(F.max_by(F.struct("x1", "x2", "sum"), "depth").alias("e"))
             .select("conv_id", "rg", F.bit_xor("e.x1").over(earlier).alias("c1"), F.bit_xor("e.x2").over(earlier).alias("c2"), F.sum("e.sum").over(earlier).alias("c"))
             .filter("c IS NOT NULL"))
    p1, p2 = (F.col(x).bitwiseXOR(F.coalesce(c, F.lit(0).cast("long"))) for x, c in (("x1", "c1"), ("x2", "c2")))
    return (local.join(F.broadcast(carry), ["conv_id", "rg"], "left")
            .select("conv_id", "depth", p1.alias("p1"), p2.alias("p2"), p1.bitwiseXOR(F.col("z1")).alias("q1"), p2.bitwiseXOR(F.col("z2")).alias("q2"),
                    "words", (F.col("sum") + F.coalesce("c", F.lit(0))).alias("through"), "last"))


# -------------------------------------------------------------------- sketch

def cells_of(bits: int, p1: np.ndarray, p2: np.ndarray) -> Iterator[np.ndarray]:
    """The cell of each prefix in either row of a sketch of 2 ** bits cells a row."""
    return ((p.view(np.uint64) & np.uint64((1 << bits) - 1)).astype(np.int64) for p in (p1, p2))


class Sketch:
    """Count-min rows of 2 ** bits cells, kept as one bit: the count passed one."""

    def __init__(self, bits: int):
        self.bits = bits
        self.over = np.zeros((2, 1 << bits >> 3), np.uint8)

    def single(self, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
        """The estimate is one: no other prefix has this digest."""
        out = np.zeros(len(p1), bool)
        for row, cell in zip(self.over, cells_of(self.bits, p1, p2)):
            out |= (row[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 0
        return out


def count_prefixes(table: DataFrame, n: int, most_bits: int = MOST_BITS) -> Sketch:
    """The sketch of all rows' (p1, p2): each task counts its rows, pages of cells
    are added up by tasks of their own, and the driver joins the pages. Its size
    follows the number of prefixes up to 2 ** most_bits cells a row (64 MB at the
    default); beyond, more prefixes are taken for shared ones, and no result changes."""
    bits = min(max(PAGE.bit_length() - 1, (CELLS * n).bit_length()), most_bits)
    sketch, pages = Sketch(bits), max(1, (1 << bits) // PAGE)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        def flush():
            for row, cells in enumerate(map(np.concatenate, zip(*seen))):
                cell, times = np.unique(cells, return_counts=True)
                page = cell // PAGE
                cut = np.flatnonzero(np.append(True, page[1:] != page[:-1]))
                code = ((cell % PAGE) << 1 | (times > 1)).astype(np.uint32)
                blobs = [c.tobytes() for c in np.split(code, cut[1:])]
                yield pa.RecordBatch.from_arrays([pa.array((row * pages + page[cut]).astype(np.int32)), pa.array(blobs, pa.binary())], names=["page", "cells"])
            seen.clear()
        for batch in batches:
            if batch.num_rows:
                seen.append(tuple(cells_of(bits, *(batch.column(c).to_numpy() for c in ("p1", "p2")))))
            if sum(len(s[0]) for s in seen) >= 1 << 21:
                yield from flush()
        if seen:
            yield from flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, over = None, np.zeros(PAGE, bool), np.zeros(PAGE, bool)
        def done():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(over, bitorder="little").tobytes()], pa.binary())], names=["page", "over"])
        for batch in batches:
            for page, blob in zip(batch.column("page").to_pylist(), batch.column("cells")):
                if page != now:
                    if now is not None:
                        yield done()
                    now = page
                    once[:], over[:] = False, False
                code = np.frombuffer(blob.as_buffer(), np.uint32)
                cell = code >> 1
                over[cell] |= once[cell] | (code & 1).astype(bool)
                once[cell] = True
        if now is not None:
            yield done()

    written = cut_lineage(table.select("p1", "p2").mapInArrow(count, "page int, cells binary").repartition("page").sortWithinPartitions("page")
                          .mapInArrow(add, "page int, over binary"), "sketch").toArrow()
    for page, over in zip(written.column("page").to_pylist(), written.column("over").to_pylist()):
        at = page % pages * (PAGE >> 3)
        sketch.over[page // pages, at:at + (PAGE >> 3)] = np.frombuffer(over, np.uint8)[:sketch.over.shape[1]]
    return sketch


def screen(table: DataFrame, sketch: Sketch) -> DataFrame:
    """``table`` with ``single`` and ``under`` (the prefix before is single), as the
    sketch proves them. The empty prefix is never taken for single."""
    shared = table.sparkSession.sparkContext.broadcast(sketch)  # at most 2 ** MOST_BITS / 4 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p1, p2, q1, q2, depth = (batch.column(c).to_numpy() for c in ("p1", "p2", "q1", "q2", "depth"))
            single, under = shared.value.single(p1, p2), shared.value.single(q1, q2) & (depth > 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(single), pa.array(under)], names=[*batch.schema.names, "single", "under"])

    return table.mapInArrow(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in table.schema)}, single boolean, under boolean")


# ---------------------------------------------------------------------- trie

def _digests_of_ends(ends: DataFrame, per_range: int) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): the SHA-256 of each node's ids,
    ascending and joined by commas. The ids of a node are joined in ranges of bounded
    size; a node in several ranges is hashed piece by piece, in their order."""
    ranged = _ranged(ends, [F.col(c) for c in (*NODE, "conv_id")], per_range, "ends")
    pieces = cut_lineage(ranged.groupBy(*NODE, "rg").agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")), "end-pieces")
    n = pieces.groupBy(*NODE).agg(F.count("*").alias("n"), F.max("ids").alias("ids"))
    whole = n.filter("n = 1").select(*NODE, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    several = pieces.join(n.filter("n > 1").select(*NODE), NODE, "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        def done():
            return pa.RecordBatch.from_pylist([dict(zip((*NODE, "ends_sha256"), (*now, sha.hexdigest())))],
                                              schema=pa.schema([(c, pa.int64()) for c in NODE] + [("ends_sha256", pa.string())]))
        for batch in batches:
            for row in batch.to_pylist():
                node = tuple(row[c] for c in NODE)
                if node != now:
                    if now is not None:
                        yield done()
                    now, sha = node, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(row["ids"].encode())
        if now is not None:
            yield done()

    hashed = several.repartition(*NODE).sortWithinPartitions(*NODE, "rg").select(*NODE, "ids").mapInArrow(run, "p1 long, p2 long, depth long, ends_sha256 string")
    return whole.unionByName(hashed)


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, per_range: int = 1 << 18, sketch_bits: int = MOST_BITS) -> DataFrame:
    """A row per node: conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256. The node's last turn is
    turn ``depth`` of conversation ``conv_id``.

    ``turns`` is :func:`turn_digests` (with a column ``part``, ordered before the
    turn, if there is one); ``conversations`` lists conv_id, turnless ones too
    (default: those with turns).

    - Turns are ordered by turn, nulls first; equal ones by the digests of role and
      text. Repeated rows are turns of their own.
    - No conversation: no node. Only turnless ones: the root, a leaf.
    - Texts of any length are one digest; long conversations are cut into ranges.
    - Two prefixes are one node if 128 bits of digest agree.
    """
    if "part" not in turns.columns:
        turns = turns.withColumn("part", F.lit(0))
    convs = turns.select("conv_id").distinct() if conversations is None else conversations.select("conv_id")
    table = prefixes(turns, per_range)
    n = turns.count()
    table = cut_lineage(screen(table, count_prefixes(table, n, sketch_bits)), "prefixes")
    near = table.filter("NOT under")
    groups = near.filter("NOT single").groupBy(*NODE).agg(F.min("conv_id").alias("first"), F.count("*").alias("n"), F.count_if("last").alias("n_ends"))
    # Joined on the node: AQE splits a node that most conversations share.
    grouped = cut_lineage(near.filter("NOT single").join(groups, NODE).select(*NODE, "conv_id", "words", "through", "last", "first", "n", "n_ends"), "grouped")

    total = convs.agg(F.min("conv_id").alias("root"), F.count("*").alias("n")).first()
    if not total.n:
        return table.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    root = F.lit(total.root).cast("long")
    # Of each conversation: the deepest node it doesn't own, its owner, its words up to there.
    other = F.col("first") < F.col("conv_id")
    owned = cut_lineage(grouped.groupBy("conv_id").agg(
        F.max(F.when(other, F.col("depth"))).alias("d"), F.max(F.when(other, F.col("through"))).alias("through_d"),
        F.max_by("first", F.when(other, F.col("depth"))).alias("owner_d"),
        F.max(F.col("last") & (other | (F.col("n") > F.col("n_ends")))).alias("no_leaf")), "owned")

    def with_owner(rows: DataFrame) -> DataFrame:
        begin = F.when(F.col("d").isNotNull(), F.col("d") + 1).otherwise(F.when(F.col("conv_id") == root, 0).otherwise(1))
        return (rows.join(owned, "conv_id", "left").withColumn("begin", begin)
                .withColumn("parent", F.when(F.col("depth") > F.col("begin"), F.col("conv_id")).otherwise(F.coalesce("owner_d", root)))
                .withColumn("child", ~F.col("last") & (F.col("begin") <= F.col("depth") + 1))
                .withColumn("leaf", ~F.coalesce("no_leaf", F.lit(False)))
                .withColumn("saved", F.greatest(F.lit(0), F.coalesce("through_d", F.lit(0)) - F.col("through") + F.col("words"))))

    def node(conv: Column, parent: Column, convs: Column, children: Column, leaves: Column, saved: Column, ends: Column) -> list[Column]:
        return [conv.alias("conv_id"), F.col("depth"), parent.alias("parent_conv_id"), convs.cast("long").alias("n_convs"), children.cast("long").alias("n_children"),
                leaves.cast("long").alias("n_leaves"), saved.cast("long").alias("saved_tokens"), ends.alias("ends_sha256")]

    one, none, own_id = F.lit(1), F.lit(0), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    sole_end = F.when(F.col("last"), own_id).otherwise(F.lit(EMPTY_SHA))
    tails = table.filter("under").select(*node(F.col("conv_id"), F.col("conv_id"), one, (~F.col("last")).cast("long"), one, none, sole_end))
    single = with_owner(near.filter("single"))
    heads_of_tails = single.select(*node(F.col("conv_id"), F.col("parent"), one, (~F.col("last")).cast("long"), one, none, sole_end))

    sums = (with_owner(grouped).groupBy(*NODE).agg(
        F.min("first").alias("first"), F.max(F.when(F.col("conv_id") == F.col("first"), F.col("parent"))).alias("parent"), F.max("n").alias("n"),
        F.count_if("child").alias("children"), F.count_if("leaf").alias("leaves"), F.sum("saved").alias("saved")))
    turnless = convs.join(table.select("conv_id").distinct(), "conv_id", "left_anti") if conversations is not None else convs.limit(0)
    zero = F.lit(0).cast("long")
    ends = grouped.filter("last").select(*NODE, "conv_id").unionByName(turnless.select(zero.alias("p1"), zero.alias("p2"), zero.alias("depth"), "conv_id"))
    ends = cut_lineage(_digests_of_ends(cut_lineage(ends, "ending"), per_range), "end-digests")
    shared = (sums.join(ends, NODE, "left")
              .select(*node(F.col("first"), F.col("parent"), F.col("n"), F.col("children"), F.col("leaves"), F.col("saved"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))))

    # The root: sums over all conversations.
    top = [with_owner(rows.filter("depth = 1")).agg(F.count_if(F.col("begin") <= 1).alias("children"), F.count("*").alias("convs")) for rows in (grouped, near.filter("single"))]
    below = top[0].unionByName(top[1]).agg(F.sum("children").alias("children"), F.sum("convs").alias("convs"))
    inner = owned.agg(F.count_if("no_leaf").alias("no_leaf"), F.coalesce(F.sum("through_d"), F.lit(0)).alias("saved"))
    end = F.lit(ends.filter("depth = 0").agg(F.max("ends_sha256")).first()[0] or EMPTY_SHA)
    counted, more = below.first(), inner.first()
    leaves = counted.convs - more.no_leaf if counted.convs else 1
    base = table.sparkSession.range(1).withColumn("depth", F.lit(0).cast("long"))
    top_row = base.select(*node(root, F.lit(None).cast("long"), F.lit(total.n), F.lit(counted.children), F.lit(leaves), F.lit(more.saved), end))
    return shared.unionByName(heads_of_tails).unionByName(tails).unionByName(top_row)
