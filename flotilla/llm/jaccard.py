"""Exact 5-word-shingle Jaccard join with a count-vector R-tree.

How it holds at scale:

* Documents with the same set form a class (grouped by a 128-bit digest); a
  class is one node, however many copies it has.
* Two sets of Jaccard similarity 0.8 share a shingle among the first fifth of
  either, in any common order of shingles (prefix filter), which deals the
  nodes into small groups: the nodes that share a prefix shingle. Shingles
  noted as frequent come last in the order, so a passage found everywhere makes
  no large group; the order never changes the result.
* With a prefix longer by a twentieth, similar sets share not one but a
  twentieth of their shingles there, so a node with fewer prefix shingles that
  anyone shares is out before any pair is looked at: a common passage alone
  keeps no document in.
* Inside a group the candidates come from an R-tree over the shingles' group
  counts (:mod:`flotilla.llm.rtree`). A first pass over all groups notes the
  nodes that have a candidate anywhere; the others, nearly all documents, need
  no set, so whole sets are only built and moved for the nodes noted.
* Step A: every noted node joins its two most popular groups, with its whole
  set; survivors of the tree are verified there and linked with union-find, so a
  group of thousands of near copies costs no more than its spanning links.
* Step B: all groups again, without sets, for pairs of nodes that didn't meet in
  step A and aren't linked by it. Pairs that share enough prefix shingles (the
  filter's count, not just one) get their sets joined and are verified.
* Groups over a size are split into blocks by a hash, and every pair of blocks
  is a group of its own: no task gathers an unbounded group.
* Components over all links are found by star rounds, each cut to the shared
  folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flotilla.llm import rtree, text as T
from flotilla.llm.shared import Tables, whole_row
from flotilla.session import cut_lineage

SHINGLE = 5
#: A group over this many nodes, or shingles of all its nodes, is split into blocks.
BLOCK_NODES = 2000
BLOCK_SHINGLES = 4_000_000
#: Frequent shingles: noted when a task's slice of rows holds NOTE of them and the
#: corpus NOTED; at most ORDER_LIMIT are used. They only order the shingles.
NOTE, NOTED, ORDER_LIMIT = 3, 64, 1 << 16
#: Size of the filter for shingles that more than one document has: fixed bits;
#: a full filter passes more rows to the exact join after it, never fewer.
FILTER_BITS = 26


def least_common(n):
    """Shingles two sets must share between the smaller's index prefix (``n``: its
    size) and the larger's probe prefix."""
    return np.maximum(1, n // 50)


def probe_length(n):
    """Shingles of a set of ``n`` to look up."""
    return n - (4 * n + 4) // 5 + least_common(n)


def index_length(n):
    """Shingles of a set of ``n`` to be found by sets that are at least as large."""
    return n - (8 * n + 8) // 9 + least_common(n)


def long_prefix_length(n):
    """Shingles of a set of ``n`` that must hold :func:`least_shared` ones that any
    similar set has in its own long prefix."""
    return n - (4 * n + 4) // 5 + max(1, n // 20)


def least_shared(n):
    """As a similar set may have only four fifths of the shingles."""
    return max(1, (4 * n + 4) // 5 // 20)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end, sorted distinct shingles, number per row)."""
    for begin, end, texts in T.slices(batch):
        hashes, n_words = T.words(texts)
        grams, n = T.ngrams(hashes, n_words, SHINGLE, short=True)
        yield begin, end, *T.distinct_per_text(grams, n)


def _digest(values: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _features(batches: Iterator[pa.RecordBatch], more: tuple[str, ...] = ()) -> Iterator[pa.RecordBatch]:
    """A row per document (node, d2, n) and a row per locally frequent shingle.
    ``more``: columns of longs that documents keep."""
    schema = pa.schema([(c, pa.int64()) for c in ("id", "node", "d2", "n", "tok", "cnt", *more)])
    held: list[np.ndarray] = []

    def noted() -> pa.RecordBatch:
        tok, cnt = np.unique(np.concatenate(held), return_counts=True)
        tok, cnt = tok[cnt >= NOTE], cnt[cnt >= NOTE]
        held.clear()
        none = pa.nulls(len(tok), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(tok.view(np.int64)), pa.array(cnt), *[none] * len(more)], schema=schema)

    for batch in batches:
        ids = batch.column("id")
        for begin, end, grams, n in _sets(batch):
            ends = np.cumsum(n)
            d = [_digest(grams[a:b]) for a, b in zip(ends - n, ends)]
            none = pa.nulls(end - begin, pa.int64())
            yield pa.RecordBatch.from_arrays([ids.slice(begin, end - begin), pa.array([x[0] for x in d], pa.int64()),
                                              pa.array([x[1] for x in d], pa.int64()), pa.array(n, pa.int64()), none, none,
                                              *[batch.column(c).slice(begin, end - begin) for c in more]], schema=schema)
            held.append(grams)
            if sum(map(len, held)) >= 2_000_000:
                yield noted()
    if held:
        yield noted()


class Order:
    """The common order of shingles: by hash, but the noted ones last, rarer first."""

    def __init__(self, noted: np.ndarray):
        self.sorted = np.sort(noted)
        self.rank = np.argsort(noted)  # noted: ascending by count
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(noted & np.uint64((1 << 20) - 1)).astype(np.intp)] = True

    def keys(self, grams: np.ndarray) -> np.ndarray:
        out = grams >> np.uint64(1)
        maybe = np.flatnonzero(self.seen[(grams & np.uint64((1 << 20) - 1)).astype(np.intp)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.sorted, grams[maybe]), len(self.sorted) - 1)
            hit = self.sorted[at] == grams[maybe]
            out[maybe[hit]] = np.uint64(1 << 63) + self.rank[at[hit]].astype(np.uint64)
        return out

    def prefixes(self, grams: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        """Places of the long prefix of each set, in the common order (ties by hash)."""
        keys = self.keys(grams)
        ends = np.cumsum(n)
        out = []
        for a, b in zip((ends - n).tolist(), ends.tolist()):
            p = long_prefix_length(b - a) if b > a else 0
            k = keys[a:b]
            if 0 < p < len(k):  # the sets are sorted by hash, so a stable sort breaks ties by it
                cut = np.partition(k, p - 1)[p - 1]
                place = np.flatnonzero(k <= cut)
                place = place[np.argsort(k[place], kind="stable")][:p]
            else:
                place = np.argsort(k, kind="stable")[:p]
            out.append(place + a)
        return out


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64((1 << FILTER_BITS) - 1)).astype(np.intp)


def _prefix_rows(order):
    """Prefix shingles of every document, for counting."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, grams, n in _sets(batch):
                places = order.value.prefixes(grams, n)
                yield pa.RecordBatch.from_arrays([pa.array(grams[np.concatenate(places)].view(np.int64))] if places else [pa.array([], pa.int64())], names=["tok"])
    return run


def _shared_rows(order, bits):
    """Documents with enough prefix shingles that the filter holds: these
    shingles, their places in the prefix, and the set's group counts."""
    schema = pa.schema([("id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("toks", pa.list_(pa.int64())),
                        ("places", pa.list_(pa.int64())), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for begin, end, grams, n in _sets(batch):
                vec = rtree.count_vectors(grams, n)
                ends = np.cumsum(n)
                rows = []
                hit = bits.value[_slot(grams) >> 3] >> (_slot(grams) & 7).astype(np.uint8) & 1
                for i, place in enumerate(order.value.prefixes(grams, n)):
                    shared = np.flatnonzero(hit[place]) if len(place) else place
                    if len(place) and len(shared) >= least_shared(int(n[i])):
                        whole = grams[ends[i] - n[i]:ends[i]]
                        rows.append({"id": ids[begin + i], "node": _digest(whole)[0], "n": int(n[i]), "toks": grams[place[shared]].view(np.int64),
                                     "places": shared, "vec": vec[i].tobytes()})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def _whole_sets(bits):
    """(id, node, elements) of the documents whose id the filter holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = _slot(T.mix(batch.column("id").to_numpy().view(np.uint64)))
            batch = batch.filter(pa.array((bits.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)))
            ids = batch.column("id")
            for begin, end, grams, n in _sets(batch):
                ends = np.cumsum(n)
                sets = [grams[a:b] for a, b in zip(ends - n, ends)]
                yield pa.RecordBatch.from_arrays([ids.slice(begin, end - begin), pa.array([_digest(x)[0] for x in sets], pa.int64()),
                                                  pa.array([x.tobytes() for x in sets], pa.binary())], names=["id", "node", "elements"])
    return run


def _filter_of(slots: DataFrame):
    """Broadcast bit filter of the slots (column ``slot``): at most
    2 ** (FILTER_BITS - 3) rows reach the driver, 8 MB of bits in all."""
    filled = (slots.selectExpr("cast(shiftright(slot, 3) AS int) AS at", "shiftleft(1, cast(slot & 7 AS int)) AS bit")
              .groupBy("at").agg(F.bit_or("bit").cast("short").alias("bits")).toArrow())
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    bits[filled.column("at").to_numpy()] = filled.column("bits").to_numpy().astype(np.uint8)
    return slots.sparkSession.sparkContext.broadcast(bits)


def _id_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_slot(T.mix(batch.column("id").to_numpy().view(np.uint64))))], names=["slot"])


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys of a sorted stream, as many whole runs at a
    time as one batch holds."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        cols = [table.column(k).to_numpy() for k in keys]
        last = len(table) - 1
        same = np.ones(len(table), bool)
        for c in cols:
            same &= c == c[last]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None and len(rest):
        yield rest


def _runs(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Bounds of the runs of equal keys."""
    new = np.zeros(len(table), bool)
    new[0] = True
    for k in keys:
        c = table.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), len(table))


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def overlaps(elements: list[np.ndarray], one: np.ndarray) -> np.ndarray:
    """How many elements of the sorted set ``one`` each of the sets holds."""
    all_of = np.concatenate(elements)
    at = np.minimum(np.searchsorted(one, all_of), len(one) - 1)
    ends = np.cumsum([len(e) for e in elements])
    hits = np.concatenate([[0], np.cumsum(one[at] == all_of)])
    return hits[ends] - hits[ends - [len(e) for e in elements]]


def link_group(nodes: np.ndarray, sizes: np.ndarray, points: np.ndarray, elements: list[np.ndarray], side: np.ndarray | None = None) -> np.ndarray:
    """Component (its smallest node) of each node of a group, by verified links;
    with ``side`` only links between different sides are looked for."""
    union = Union(len(nodes))
    tree = rtree.RTree(points, sizes)
    for i in range(len(nodes)):
        found = tree.query(points[i], int(sizes[i]))
        found = found[found < i]
        if side is not None:
            found = found[side[found] != side[i]]
        for a in range(0, len(found), 64):
            root = union.find(i)
            some = [j for j in found[a:a + 64].tolist() if union.find(j) != root]
            if some:
                shared = overlaps([elements[j] for j in some], elements[i])
                for j, ok in zip(some, shared >= rtree.least_overlap(sizes[some], sizes[i])):
                    if ok:
                        union.join(i, j)
    roots = np.array([union.find(i) for i in range(len(nodes))])
    least = np.full(len(nodes), np.iinfo(np.int64).max)
    np.minimum.at(least, roots, nodes)
    return least[roots]


def _link_homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["home", "i", "j"]
    for table in groups_of(batches, keys):
        again = _runs(table, [*keys, "node"])[:-1]  # a node that came twice counts once
        table = table.take(pa.array(again)) if len(again) < len(table) else table
        bounds = _runs(table, keys)
        x = _columns(table, ["node", "n", "i", "j", "own"])
        raw = table.column("elements")
        comp = x["node"].copy()
        for a, b in zip(bounds, bounds[1:]):
            if b - a > 1:
                elements = [np.frombuffer(e.as_py(), np.uint64) for e in raw.slice(a, b - a)]
                side = x["own"][a:b] if x["i"][a] != x["j"][a] else None
                comp[a:b] = link_group(x["node"][a:b], x["n"][a:b], x["points"][a:b], elements, side)
        yield pa.RecordBatch.from_arrays([pa.array(x["node"]), pa.array(comp)], names=["node", "comp"])


def candidate_pairs(run: np.ndarray, x: dict[str, np.ndarray], wanted) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (a, b) within each run that are ``wanted`` and that the tree lets
    pass. Runs no larger than a leaf are compared point by point."""
    n, points = x["n"], x["points"]
    sizes = np.diff(run)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    small = np.repeat(sizes <= rtree.LEAF, sizes)
    for lag in range(1, rtree.LEAF):
        a = np.flatnonzero((owner[lag:] == owner[:-lag]) & small[lag:])
        if not len(a):
            break
        b = a + lag
        ok = wanted(x, a, b) & rtree.sizes_fit(n[a], n[b])
        a, b = a[ok], b[ok]
        ok = np.minimum(points[a], points[b]).sum(axis=1) >= rtree.least_overlap(n[a], n[b])
        yield a[ok], b[ok]
    for g in np.flatnonzero(sizes > rtree.LEAF):
        lo, hi = run[g], run[g + 1]
        tree = rtree.RTree(points[lo:hi], n[lo:hi])
        for i in range(lo, hi):
            b = tree.query(points[i], int(n[i])) + lo
            b = b[b > i]
            b = b[wanted(x, np.full(len(b), i), b)]
            yield np.full(len(b), i), b


def _roles(x: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs from the two sides of their block pair whose shingle lies in the
    smaller set's index prefix."""
    sides = (x["i"][a] == x["j"][a]) | (x["own"][a] != x["own"][b])
    smaller = np.where(x["n"][a] < x["n"][b], x["index"][a], np.where(x["n"][a] > x["n"][b], x["index"][b], x["index"][a] | x["index"][b]))
    return sides & smaller


def _open(x: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of these, pairs that didn't meet in step A and that it didn't link."""
    met = np.zeros(len(a), bool)
    for one in ("home_1", "home_2"):
        for two in ("home_1", "home_2"):
            met |= x[one][a] == x[two][b]
    return _roles(x, a, b) & (x["comp"][a] != x["comp"][b]) & ~met


def _columns(table: pa.Table, names: list[str]) -> dict[str, np.ndarray]:
    out = {k: table.column(k).to_numpy() for k in names}
    out["points"] = rtree.as_bounds(np.frombuffer(b"".join(table.column("vec").to_pylist()), np.uint8).reshape(-1, rtree.GROUPS))
    return out


GROUP = ["tok", "i", "j"]


def _candidate_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sent = np.zeros(0, np.int64)  # of this task: no more than its rows
    for table in groups_of(batches, GROUP):
        x = _columns(table, ["node", "n", "i", "j", "own", "index"])
        noted = np.zeros(len(table), bool)
        for a, b in candidate_pairs(_runs(table, GROUP), x, _roles):
            noted[a] = noted[b] = True
        new = np.setdiff1d(x["node"][noted], sent)
        sent = np.union1d(sent, new)
        yield pa.RecordBatch.from_arrays([pa.array(new)], names=["node"])


def _pair_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in groups_of(batches, GROUP):
        x = _columns(table, ["node", "n", "comp", "home_1", "home_2", "i", "j", "own", "index"])
        for a, b in candidate_pairs(_runs(table, GROUP), x, _open):
            if len(a):
                pair = np.sort(np.stack([x["node"][a], x["node"][b]]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1]), pa.array(least_common(np.minimum(x["n"][a], x["n"][b])))], names=["a", "b", "least"])


def _grouped(members: DataFrame, *more: str, by: str = "tok") -> DataFrame:
    """Members dealt and sorted by group; a group of several blocks is dealt once
    for every pair of blocks."""
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (members.withColumn("own", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(by, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "vec", *more))
    # A stated number of partitions: the work of a group is more than its bytes tell.
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, by, "i", "j").sortWithinPartitions(by, "i", "j", "n" if by == "tok" else "node", "node")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [(a, b) for a, b, ea, eb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "el_a", "el_b")))
                if _similar(np.frombuffer(ea, np.uint64), np.frombuffer(eb, np.uint64))]
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keep], pa.int64()), pa.array([k[1] for k in keep], pa.int64())], names=["a", "b"])


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    return int(overlaps([a], b)[0]) >= rtree.least_overlap(len(a), len(b))


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over the links (a, b), for every
    node that has one. Alternates large-star and small-star rounds; each round
    is an aggregate and a join over the links, cut to the shared folder."""
    edges = cut_lineage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    was = _signature(edges)
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.filter("b > a").join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = cut_lineage(large.distinct(), "large-star")  # a > b
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        star = cut_lineage(large.join(small, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                           .select("e.a", "e.b").filter("a <> b").distinct(), "small-star")
        now = _signature(star)
        if now == was:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("comp"))).distinct()
        edges, was = star, now


def _signature(edges: DataFrame) -> tuple:
    """Tells sets of links apart: their number and two sums of hashes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.sum(F.xxhash64("b", F.lit(1), "a").cast("decimal(20,0)"))).first())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id), a row per row of ``docs``.

    Two documents link when the Jaccard similarity of their sets of distinct
    5-word shingles is at least 0.8 (fewer words: the whole sequence is the only
    shingle). ``component_id`` is the smallest id reachable over links.

    - Null texts, and texts without words, have an empty set and link with nothing.
    - Rows without an id have their set's size and no component; they link nothing.
    - Rows repeated under one id are judged by their own texts.
    - Other columns don't matter and aren't returned.
    """
    return _labelled(docs, id_col, text_col).select("id", "n_shingles", "component_id")


def text_key(text_col: str) -> list[Column]:
    """Two hashes of a row's text, t1 and t2."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("text"), text).alias("t2")]


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates (:func:`near_duplicates`).

    The row with the smallest id stays; of several under that id the one with
    the smallest hashes of its text, and of rows equal in id and text the one with the
    smallest hash of its other columns. Rows repeated under one id belong each to
    the group of its own text. Rows without an id, or without words, all stay.
    """
    key = ["id", "t1", "t2"]
    rows = _labelled(docs, id_col, text_col, text_key(text_col)).filter("component IS NOT NULL")
    counted = cut_lineage(rows.groupBy("component", *key).agg(F.count(F.lit(1)).alias("n")), "group-rows")
    first = counted.groupBy("component").agg(F.min(F.struct(*key)).alias("first"))
    # A text has one component, so a key is here once: what goes, and what stays but has equals.
    judged = cut_lineage(counted.join(first, "component").select(*key, (F.struct(*key) == F.col("first")).alias("stays"), "n")
                         .filter("NOT stays OR n > 1").drop("n"), "group-verdicts")
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), *text_key(text_col), whole_row(docs).alias("row"))
    out = base.join(judged.drop("stays"), key, "left_anti").select("row.*")
    repeated = judged.filter("stays").drop("stays")
    if not repeated.isEmpty():
        plain = [F.col("row")[c] for c in docs.columns if not any(t in docs.schema[c].dataType.simpleString() for t in ("map<", "variant"))]
        out = out.union(base.join(repeated, key, "left_semi").groupBy(*key).agg(F.min_by("row", F.xxhash64(*plain)).alias("row")).select("row.*"))
    return out


def _labelled(docs: DataFrame, id_col: str, text_col: str, more: list[Column] | None = None) -> DataFrame:
    """The rows of :func:`near_duplicates`, with ``component`` (null for what links
    with nothing by rule) and, if ``more`` is the text's key, t1 and t2. Two components
    may have one smallest id, under which rows repeat; ``component`` tells them apart."""
    spark = docs.sparkSession
    keep = Tables(spark, "jaccard")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    noted_schema = "id long, node long, d2 long, n long, tok long, cnt long"
    names = ("t1", "t2") if more else ()
    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), *more) if more else rows
    first = keep.cut(keyed.mapInArrow(lambda batches: _features(batches, names), noted_schema + "".join(f", {c} long" for c in names)), "features")
    feats = first.filter("tok IS NULL").select("id", "node", "d2", "n", *names)
    named = rows.filter("id IS NOT NULL")
    # At most ORDER_LIMIT rows reach the driver.
    noted = (first.filter("tok IS NOT NULL").groupBy("tok").agg(F.sum("cnt").alias("cnt")).filter(F.col("cnt") >= NOTED)
             .orderBy(F.desc("cnt"), "tok").limit(ORDER_LIMIT).orderBy("cnt", "tok").collect())
    order = spark.sparkContext.broadcast(Order(np.array([r.tok for r in noted], np.int64).view(np.uint64)))

    counted = named.mapInArrow(_prefix_rows(order), "tok long").groupBy("tok").count().filter("count > 1")
    bits = _filter_of(counted.selectExpr(f"tok & {(1 << FILTER_BITS) - 1} AS slot"))

    classes = keep.cut(feats.filter("id IS NOT NULL AND n > 0").groupBy("node", "d2", "n").agg(F.min("id").alias("id")), "classes")
    shared = keep.cut(named.mapInArrow(_shared_rows(order, bits), "id long, node long, n long, toks array<long>, places array<long>, vec binary")
                         .join(classes.select("id", "node"), ["id", "node"], "left_semi"), "shared")

    # Nodes with enough prefix shingles that another node has too.
    members = shared.select("node", "n", F.explode(F.arrays_zip("toks", "places")).alias("t")).select("node", "n", F.col("t.toks").alias("tok"), F.col("t.places").alias("place")).distinct()
    twice = keep.cut(members.groupBy("tok").count().filter("count > 1").select("tok"), "shared-shingles")
    least = F.greatest(F.lit(1), F.expr("((4 * n + 4) div 5) div 20"))
    enough = keep.cut(members.join(twice, "tok", "left_semi").groupBy("node", "n").count().filter(F.col("count") >= least)
                         .join(shared.dropDuplicates(["node"]).select("node", "vec"), "node").select("node", "vec"), "enough")

    # Exact groups: nodes by shared shingle of the probe prefix, of two nodes at least.
    common = "greatest(1, n div 50)"
    members = (members.filter(F.expr(f"place < n - (4 * n + 4) div 5 + {common}")).join(enough, "node")
               .withColumn("index", F.expr(f"place < n - (8 * n + 8) div 9 + {common}")).drop("place"))
    sizes = keep.cut(members.groupBy("tok").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total")).filter("size > 1")
                        .select("tok", "size", F.greatest(F.ceil(F.col("size") / BLOCK_NODES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks")), "groups")
    members = keep.cut(members.join(sizes, "tok"), "members")
    keep.drop("shared", "shared-shingles", "enough", "groups")
    noted = keep.cut(_grouped(members, "index").mapInArrow(_candidate_nodes, "node long").distinct(), "noted")
    members = keep.cut(members.join(noted, "node", "left_semi"), "noted-members")
    keep.drop("members")
    reps = classes.join(noted, "node", "left_semi").select("id")
    wanted = _filter_of(reps.mapInArrow(_id_slots, "slot long"))
    # A few more documents may pass the filter; the joins on the node leave them out.
    sets = keep.cut(named.mapInArrow(_whole_sets(wanted), "id long, node long, elements binary").select("node", "elements"), "sets")

    # Step A.
    homes = members.groupBy("node", "n", "vec").agg(F.slice(F.sort_array(F.collect_list(F.struct("size", "tok", "blocks")), asc=False), 1, 2).alias("homes"))
    homes = keep.cut(homes, "homes")
    own = homes.join(sets, "node").select("node", "n", "vec", "elements", F.explode("homes").alias("h"))
    own = own.select("node", "n", "vec", "elements", F.col("h.tok").alias("home"), F.col("h.blocks").alias("blocks"))
    linked = keep.cut(_grouped(own, "elements", by="home").mapInArrow(_link_homes, "node long, comp long"), "step-a")

    # Step B: groups with nodes of several homes. Equal labels are linked nodes.
    label = linked.groupBy("node").agg(F.min("comp").alias("comp"))
    rest = members.join(homes.select("node", F.col("homes")[0]["tok"].alias("home_1"), F.coalesce(F.get("homes", 1)["tok"], F.col("homes")[0]["tok"]).alias("home_2")).join(label, "node"), "node")
    open_groups = keep.cut(rest.groupBy("tok").agg(F.min("home_1").alias("x"), F.max("home_1").alias("y"), F.min("comp").alias("p"), F.max("comp").alias("q"))
                              .filter("x <> y AND p <> q").select("tok"), "open")
    rest = rest.join(open_groups, "tok", "left_semi")
    pairs = _grouped(rest, "index", "home_1", "home_2", "comp").mapInArrow(_pair_groups, "a long, b long, least long")
    pairs = keep.cut(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("least").alias("least")).filter("n >= least").select("a", "b"), "pairs")
    verified = (pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("el_a")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("elements").alias("el_b")), "b")
                .mapInArrow(_verify, "a long, b long"))
    merged = components(linked.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(verified))

    # Components to their smallest document.
    final = merged.select("node", F.col("comp").alias("top"))
    labelled = classes.select("node", "id").join(final, "node", "left").withColumn("top", F.coalesce("top", "node"))
    least = labelled.groupBy("top").agg(F.min("id").alias("component_id"))
    labels = keep.cut(labelled.join(least, "top").groupBy("node").agg(F.min("component_id").alias("component_id"), F.min("top").alias("top")), "labels")
    keep.drop("classes", "noted", "noted-members", "sets", "homes", "step-a", "open", "pairs")
    out = feats.join(labels, "node", "left")
    return out.select("id", *names, F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("top")).alias("component"), F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNull(), F.lit(None).cast("long")).when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
