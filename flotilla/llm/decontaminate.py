"""Benchmark decontamination: a BM25 index of test items with block maxima.

The items (not the corpus) are indexed. Every training passage (overlapping
windows that hold any item whole) is a query. Scores are divided by the
item's score for its own text, so one threshold fits items of all lengths.
Postings lie in blocks of items with the largest weight of each term in each
block; as in block-max WAND, a passage whose terms' list maxima can't reach
the threshold is passed over, then every block whose block maxima can't, and
only what is left is scored. All items over the threshold are retrieved (no
top-k), and each is verified by the word n-grams of its question and answer.

A part of the index covers a bounded amount of item text (``shard_bytes``). What
scores and windows take from the benchmark (document frequencies, number, mean and
greatest length of its items) is counted once over all of it and handed to every
part, so results don't depend on the number of parts. Parts are built by tasks,
written to the shared folder and searched in one pass over the corpus; a worker
holds a few of them at a time. The corpus is only mapped over: nothing of it is
shuffled, however often a passage repeats.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from flotilla.llm import text as T
from flotilla.llm.shared import attempt_name, open_output, read_bytes, whole_row
from flotilla.session import cut_lineage, fresh_path

K1, B = 1.2, 0.75
BLOCK = 8
GRAM = 5
MATCHES = "array<struct<item_id: bigint, score: double, question_overlap: double, answer_overlap: double>>"


#: Parts of an index that a worker keeps.
PARTS_HELD = 4


@dataclass(frozen=True)
class Whole:
    """What scores and windows take from the whole benchmark."""
    n: int                   # items with a word
    mean: float              # words of an item
    longest: int
    terms: np.ndarray        # sorted hashes, those of a part at least
    df: np.ndarray           # items that hold each

    def frequency(self, terms: np.ndarray) -> np.ndarray:
        return self.df[np.searchsorted(self.terms, terms)]


@dataclass(frozen=True)
class Index:
    item_ids: np.ndarray
    terms: np.ndarray        # sorted hashes
    first: np.ndarray        # postings of a term: first[t] : first[t + 1], ascending by item
    items: np.ndarray
    weights: np.ndarray      # shares of the item's score for itself
    most: np.ndarray         # largest weight of a term
    block_first: np.ndarray  # blocks of a term: block_first[t] : block_first[t + 1]
    blocks: np.ndarray
    block_most: np.ndarray
    question: list[np.ndarray]  # sorted n-gram hashes
    answer: list[np.ndarray]
    sizes: np.ndarray        # (items, 2): words an n-gram has in the question, in the answer
    stride: int              # words between passages; a passage has twice as many

    @property
    def n_blocks(self) -> int:
        return -(-len(self.item_ids) // BLOCK)


def _grams(words: np.ndarray) -> tuple[np.ndarray, int]:
    n = min(GRAM, len(words))
    return (np.unique(T._gram(words, n)) if n else np.zeros(0, np.uint64)), n


def _item_words(question: str | None, answer: str | None) -> tuple[np.ndarray, np.ndarray]:
    return tuple(T.words([(x or "").encode()], T.TERMS)[0] for x in (question, answer))


def build(items: list[tuple[int, str | None, str | None]], whole: Whole | None = None) -> Index:
    """Index of (item id, question, answer or None), a part of the benchmark that
    ``whole`` describes, or all of it. Items without a word are left out."""
    rows = []
    for item, question, answer in sorted(items, key=lambda r: (r[0], r[1] or "", r[2] or "")):
        q, a = _item_words(question, answer)
        if len(q) + len(a):
            rows.append((item, q, a))
    n = len(rows)
    lengths = np.array([len(q) + len(a) for _, q, a in rows], np.float64)
    own, term, tf = [], [], []
    for i, (_, q, a) in enumerate(rows):
        t, c = np.unique(np.concatenate([q, a]), return_counts=True)
        own.append(np.full(len(t), i))
        term.append(t)
        tf.append(c)
    own, term, tf = (np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((own, np.int64), (term, np.uint64), (tf, np.int64)))
    terms, at = np.unique(term, return_inverse=True)
    if whole is None:
        whole = Whole(n, float(lengths.sum()) / n if n else 1.0, int(lengths.max(initial=0)), terms, np.bincount(at, minlength=len(terms)))
    df = whole.frequency(terms)
    idf = np.log1p((whole.n - df + 0.5) / (df + 0.5))
    weight = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[own] / whole.mean)) if n else np.zeros(0)
    weight = weight / np.bincount(own, weight, n)[own]
    order = np.lexsort((own, at))
    at, own, weight = at[order], own[order], weight[order]
    first = np.searchsorted(at, np.arange(len(terms) + 1))
    pair = at * (n // BLOCK + 1) + own // BLOCK
    cut = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if n else np.zeros(0, np.int64)
    grams = [(_grams(q), _grams(a)) for _, q, a in rows]
    return Index(np.array([r[0] for r in rows], np.int64), terms, first, own, weight,
                 np.maximum.reduceat(weight, first[:-1]) if n else np.zeros(0),
                 np.searchsorted(at[cut], np.arange(len(terms) + 1)), own[cut] // BLOCK, np.maximum.reduceat(weight, cut) if n else np.zeros(0),
                 [g[0][0] for g in grams], [g[1][0] for g in grams], np.array([(g[0][1], g[1][1]) for g in grams]).reshape(-1, 2),
                 max(32, whole.longest))


def _expand(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``which``, entry) for all entries first[t] : first[t + 1] of each t."""
    n = first[which + 1] - first[which]
    at = np.repeat(np.arange(len(which)), n)
    ends = np.cumsum(n)
    return at, np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first[which] - ends + n, n)


def retrieve(index: Index, words: np.ndarray, counts: np.ndarray, threshold: float):
    """All (window, item, score) with a score of at least ``threshold``, and the
    first word, end and text of each window."""
    stride = index.stride
    ends = np.cumsum(counts)
    starts = ends - counts
    windows = np.maximum(1, -(-counts // stride) - 1)  # the last holds the rest
    window_0 = np.cumsum(windows) - windows
    owner = np.repeat(np.arange(len(counts)), windows)
    begin = starts[owner] + (np.arange(len(owner)) - window_0[owner]) * stride
    end = np.minimum(begin + 2 * stride, ends[owner])
    found = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    hit = np.flatnonzero(index.terms[found] == words)
    text = np.searchsorted(ends, hit, side="right")
    block = (hit - starts[text]) // stride
    parts = []
    for back in (0, 1):  # a word lies in the window that begins with its stretch and in the one before
        w = block - back
        ok = (w >= 0) & (w < windows[text])
        parts.append(((window_0[text] + w)[ok].astype(np.uint64) << np.uint64(32)) | found[hit][ok].astype(np.uint64))
    key = np.unique(np.concatenate(parts))
    window, term = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    slack = threshold - 1e-9
    # Lists: the sum of the terms' largest weights.
    may = np.bincount(window, index.most[term], len(owner)) >= slack
    keep = may[window]
    window, term = window[keep], term[keep]
    # Blocks: the sum of the terms' largest weights in the block.
    at, entry = _expand(index.block_first, term)
    cell = window[at] * index.n_blocks + index.blocks[entry]
    cells, inverse = np.unique(cell, return_inverse=True)
    cells = cells[np.bincount(inverse, index.block_most[entry], len(cells)) >= slack]
    # Postings of what is left.
    left = np.isin(window, np.unique(cells // max(1, index.n_blocks)))
    window, term = window[left], term[left]
    at, entry = _expand(index.first, term)
    inside = np.isin(window[at] * index.n_blocks + index.items[entry] // BLOCK, cells)
    pair = window[at][inside] * len(index.item_ids) + index.items[entry][inside]
    pairs, inverse = np.unique(pair, return_inverse=True)
    score = np.bincount(inverse, index.weights[entry][inside], len(pairs))
    over = score >= slack
    pairs, score = pairs[over], score[over]
    return pairs // max(1, len(index.item_ids)), pairs % max(1, len(index.item_ids)), score, begin, end, owner


def _overlap(grams: np.ndarray, n: int, words: np.ndarray) -> float | None:
    """Share of an item's n-grams found in a passage; None without any."""
    if not len(grams):
        return None
    return float(np.isin(grams, T._gram(words, n)).mean()) if len(words) >= n else 0.0


def matches(index: Index, texts: list[bytes], threshold: float, min_overlap: float) -> list[list[dict]]:
    """Verified items of each text, with the best score and overlaps."""
    out: list[dict[int, dict]] = [{} for _ in texts]
    words, counts = T.words(texts, T.TERMS)
    if len(index.item_ids) and len(words):
        window, item, score, begin, end, owner = retrieve(index, words, counts, threshold)
        for w, i, s in zip(window.tolist(), item.tolist(), score.tolist()):
            passage = words[begin[w]:end[w]]
            q = _overlap(index.question[i], int(index.sizes[i, 0]), passage)
            a = _overlap(index.answer[i], int(index.sizes[i, 1]), passage)
            if min(x for x in (q, a) if x is not None) < min_overlap:
                continue
            row = out[owner[w]].setdefault(i, {"item_id": int(index.item_ids[i]), "score": s, "question_overlap": q, "answer_overlap": a})
            row["score"] = max(row["score"], s)
            for key, x in (("question_overlap", q), ("answer_overlap", a)):
                row[key] = x if x is None else max(row[key], x)
    return [[r[i] for i in sorted(r)] for r in out]


def _in_order(found: list[dict]) -> list[dict]:
    return sorted(found, key=lambda m: (m["item_id"], m["score"], m["question_overlap"] or 0.0, m["answer_overlap"] or 0.0))


def build_parts(bench: DataFrame, shard_bytes: int) -> list[str]:
    """Files of the index parts of (id, question, answer): a row per ``shard_bytes``
    of items reaches the driver."""
    spark = bench.sparkSession
    folder = fresh_path(spark, "bm25")
    # The place tells items repeated under one id and text apart, so they spread too.
    bench = cut_lineage(bench.withColumn("place", F.monotonically_increasing_id()), "bm25-items")
    size = F.coalesce(F.octet_length("question"), F.lit(0)) + F.coalesce(F.octet_length("answer"), F.lit(0)) + 16
    shards = max(1, -(-(bench.agg(F.sum(size)).first()[0] or 0) // shard_bytes))
    bench = bench.withColumn("part", F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int"))

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [np.concatenate(_item_words(q.as_py(), a.as_py())) for q, a in zip(batch.column("question"), batch.column("answer"))]
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array([len(w) for w in words], pa.int64()),
                                              pa.array([np.unique(w).view(np.int64) for w in words], pa.list_(pa.int64()))], names=["part", "n", "terms"])

    items = cut_lineage(bench.mapInArrow(terms_of, "part int, n long, terms array<long>").filter("n > 0"), "bm25-terms")
    n, total, longest = items.agg(F.count("*"), F.sum("n"), F.max("n")).first()
    terms = items.select("part", F.explode("terms").alias("term"))
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    of_part = terms.distinct().join(df, "term")

    def plant(items: pd.DataFrame, df: pd.DataFrame) -> pd.DataFrame:
        if not len(items):
            return pd.DataFrame({"file": []}, dtype=object)
        term, order = np.unique(df.term.to_numpy(np.int64).view(np.uint64), return_index=True)
        whole = Whole(n, total / n if n else 1.0, longest or 0, term, df.df.to_numpy(np.int64)[order])
        none = items.astype(object).where(items.notna(), None)
        name = attempt_name(folder, f"part-{items.part.iloc[0]}", ".index")
        with open_output(name) as f:
            f.write(pickle.dumps(build(list(zip(items.id, none.question, none.answer)), whole)))
        return pd.DataFrame({"file": [name]})

    written = bench.groupBy("part").cogroup(of_part.groupBy("part")).applyInPandas(plant, "file string")
    return sorted(r.file for r in cut_lineage(written, "bm25-parts").collect())


@lru_cache(maxsize=PARTS_HELD)
def _load(uri: str) -> Index:
    return pickle.loads(read_bytes(uri))


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", question_col: str = "text",
                  answer_col: str | None = None, threshold: float = 0.4, min_overlap: float = 0.4, shard_bytes: int = 16 << 20) -> DataFrame:
    """``row`` (all input columns) and ``matches``, the benchmark items leaked into
    it (ascending by item), a row per row of ``docs``.

    An item is retrieved when a passage's BM25 score is at least ``threshold`` of
    the item's score for itself, and verified when the passage holds at least
    ``min_overlap`` of the word 5-grams of its question and, if it has one, of its
    answer (shorter ones: the whole as one n-gram). Words are runs of letters
    and digits, A-Z folded.

    Null and empty texts match nothing; null ids, and items without a word, are
    left out of the index; items repeated under one id are matched one by one, and
    repeated documents judged one by one. An empty benchmark matches nothing. A long
    text is searched whole, in overlapping passages; a slice of texts, or one long
    text, is in memory with its words' hashes. Other columns, whatever their
    names, are carried in ``row``.
    """
    answer = F.col(f"`{answer_col}`").cast("string") if answer_col else F.lit(None).cast("string")
    bench = items.select(F.col(f"`{item_id_col}`").cast("long").alias("id"), F.col(f"`{question_col}`").cast("string").alias("question"), answer.alias("answer")).filter("id IS NOT NULL")
    files = build_parts(bench, shard_bytes)
    base = docs.select(whole_row(docs).alias("row"))
    schema = StructType([base.schema["row"], *StructType.fromDDL(f"matches {MATCHES}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("item_id", pa.int64())] + [(c, pa.float64()) for c in ("score", "question_overlap", "answer_overlap")]))
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for file in files:
                index = _load(file)
                for begin, _, texts in T.slices(batch, text_col, within="row"):
                    for i, more in enumerate(matches(index, texts, threshold, min_overlap)):
                        found[begin + i] += more
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(map(_in_order, found), kind)], names=["row", "matches"])

    return base.mapInArrow(run, schema)
