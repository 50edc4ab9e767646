"""Hard-negative mining by inner products of Kronecker-packed candidates.

The components of several candidates are biased to be non-negative and laid
into separated fields of one wide integer, a word per component. One product
of a word with an anchor's (biased) component multiplies that component of all
candidates in the word; summed over the components, every field holds one
candidate's exact score, because a field is as wide as its largest possible
sum. The fields are taken apart and the biases subtracted again:

    sum a*c = sum (a - low)(c - b) + low * sum (c - b) + sum a*b

Words are 64 bits wide. Where a field or a correction could pass that (huge
components), the same words are Python integers of any width.

Candidates are packed by the tasks that scan them (no shuffle) into files of
a bounded number of components, ordered by (label, id). Anchors come in blocks,
and the files are dealt to stripes of about ``stripe_rows`` rows; a task meets
one block with one stripe, file by file, and keeps each anchor's best few, so a
label or vector that a third of the rows share is spread like any other.
What a stripe found is reduced per anchor. The first pass (positives)
multiplies only the words of the anchor's label, the second all words.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as pads
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, Window, functions as F

from flotilla.llm.shared import attempt_name, filesystem, open_output, read_bytes
from flotilla.session import cut_lineage, fresh_path

#: Rows and components of a packed file.
PACK_ROWS = 8192
PACK_CELLS = 1 << 20
#: Fields of a word that isn't 64 bits wide.
BIG_FIELDS = 8
_FAR = np.iinfo(np.int64)


def _exact(x: np.ndarray) -> np.ndarray:
    return np.asarray(x).astype(object)


@dataclass
class Pack:
    """Candidates of one vector length, ordered by (label, id)."""

    ids: np.ndarray
    labels: np.ndarray
    words: np.ndarray   # (components, words)
    bits: int           # width of a field
    fields: int         # candidates in a word
    low: int            # bias of the anchors' components
    bias: np.ndarray    # of the candidates, by component
    sums: np.ndarray    # of each candidate's biased components

    @staticmethod
    def of(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: int, high: int) -> Pack:
        """Pack vectors for anchors whose components lie in low..high."""
        order = np.lexsort((ids, labels))
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        n, dim = vectors.shape
        bias = vectors.min(axis=0)
        span = max(high - low, 0)
        top = [int(a) - int(b) for a, b in zip(vectors.max(axis=0), bias)]
        bits = max(1, (span * sum(top)).bit_length())
        reach = max(1, abs(low), abs(high)) * max(1, max((abs(int(x)) for x in (*bias, *vectors.max(axis=0))), default=1)) * max(1, dim)
        if bits <= 64 and reach < 1 << 61:
            rest, kind, fields = (vectors - bias).astype(np.uint64), np.uint64, 64 // bits
        else:
            rest, kind, fields = _exact(vectors) - _exact(bias), object, BIG_FIELDS
        width = -(-n // fields)
        words = np.zeros((dim, width), kind)
        for f in range(fields):
            part = rest[f::fields]
            words[:, :len(part)] |= part.T << (kind(f * bits) if kind is np.uint64 else f * bits)
        sums = rest.sum(axis=1) if kind is object else rest.sum(axis=1).astype(np.int64)
        return Pack(ids, labels, words, bits, fields, low, bias, sums)

    def scores(self, anchors: np.ndarray, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Exact inner products of all anchors with the candidates begin:end. Those
        beyond a long are held at its ends."""
        end = len(self.ids) if end is None else end
        first, last = begin // self.fields, -(-end // self.fields)
        words = self.words[:, first:last]
        n = min(last * self.fields, len(self.ids)) - first * self.fields
        big = self.words.dtype == object
        factors = _exact(anchors) - self.low if big else (anchors - self.low).astype(np.uint64)
        product = np.zeros((len(anchors), words.shape[1]), words.dtype)
        for d in range(len(words)):  # one product per component and word
            product += factors[:, d, None] * words[d]
        out = np.empty((len(anchors), n), words.dtype)
        mask = (1 << self.bits) - 1
        for f in range(self.fields):
            here = out[:, f::self.fields]
            if big:
                here[:] = (product[:, :here.shape[1]] >> (f * self.bits)) & mask
            else:
                here[:] = (product[:, :here.shape[1]] >> np.uint64(f * self.bits)) & np.uint64(mask)
        if big:
            exact = out + self.low * self.sums[first * self.fields:][:n] + (_exact(anchors) * _exact(self.bias)).sum(axis=1)[:, None]
            out = np.clip(exact, _FAR.min, _FAR.max)
        out = out.astype(np.int64)
        if not big:
            out += self.low * self.sums[first * self.fields:][:n]
            out += (anchors * self.bias).sum(axis=1)[:, None]
        return out[:, begin - first * self.fields:][:, :end - begin]

    def save(self, uri: str) -> None:
        plain = {k: v for k, v in self.__dict__.items()}
        if self.words.dtype == object:  # as text: numbers of any width
            plain |= {"words": self.words.astype(str), "sums": self.sums.astype(str), "big": True}
        out = io.BytesIO()
        np.savez(out, **plain)
        with open_output(uri) as f:
            f.write(out.getbuffer())

    @staticmethod
    def load(uri: str) -> Pack:
        with np.load(io.BytesIO(read_bytes(uri))) as z:
            raw = {k: z[k] for k in z.files}
        if raw.pop("big", False):
            whole = np.frompyfunc(int, 1, 1)
            raw |= {"words": whole(raw["words"]), "sums": whole(raw["sums"])}
        return Pack(**raw | {k: int(raw[k]) for k in ("bits", "fields", "low")})


def best(scores: np.ndarray, ok: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of the ``k`` highest ok entries of each row, ties by smaller id."""
    if not scores.shape[1]:
        return [(ids[:0], scores[0, :0])] * len(scores)
    if scores.shape[1] > k:  # the k-th score first: few entries are left to order
        held = np.where(ok, scores, _FAR.min)
        kth = np.partition(held, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        ok = ok & (scores >= kth[:, None])
    out = []
    for row, mask in zip(scores, ok):
        at = np.flatnonzero(mask)
        at = at[np.lexsort((ids[at], -row[at]))[:k]]
        out.append((ids[at], row[at]))
    return out


def merge(old: tuple[np.ndarray, np.ndarray], new: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    if not len(new[0]):
        return old
    ids, scores = np.concatenate([old[0], new[0]]), np.concatenate([old[1], new[1]])
    at = np.lexsort((ids, -scores))[:k]
    return ids[at], scores[at]


def _rows(df: DataFrame, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    vec = F.col(f"`{vec_col}`")
    out = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), vec.cast("array<long>").alias("vec"))
    return out.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull()))


def _pack_rows(rows: DataFrame, low: int, high: int, folder: str, stripe_rows: int, n: int) -> tuple[str, int]:
    """Pack all rows where they are scanned; the manifest's path (its folders are
    the stripes) and the number of stripes."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        files = []

        def flush(dim: int) -> None:
            ids, labels, vectors = (np.concatenate(x) for x in zip(*held.pop(dim)))
            most = max(1, min(PACK_ROWS, PACK_CELLS // max(1, dim)))
            for a in range(0, len(ids), most):
                name = attempt_name(folder, f"pack-{dim}", ".npz")
                Pack.of(ids[a:a + most], labels[a:a + most], vectors[a:a + most], low, high).save(name)
                files.append({"dim": dim, "file": name, "n": len(ids[a:a + most])})

        for batch in batches:
            vec = batch.column("vec")
            flat = vec.flatten().to_numpy(zero_copy_only=False)
            length = vec.value_lengths().to_numpy(zero_copy_only=False)
            begin = np.cumsum(length) - length
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            for dim in np.unique(length).tolist():
                of = np.flatnonzero(length == dim)
                held.setdefault(dim, []).append((ids[of], labels[of], flat[begin[of, None] + np.arange(dim)].reshape(len(of), dim)))
                if sum(len(h[0]) for h in held[dim]) * max(1, dim) >= PACK_CELLS:
                    flush(dim)
            if sum(len(h[0]) * d for d, hs in held.items() for h in hs) >= 4 * PACK_CELLS:  # many lengths
                for dim in list(held):
                    flush(dim)
        for dim in list(held):
            flush(dim)
        yield pa.RecordBatch.from_pylist(files, schema=pa.schema([("dim", pa.int32()), ("file", pa.string()), ("n", pa.int32())]))

    stripes = max(1, -(-n // stripe_rows))
    manifest = f"{folder}/manifest"
    (cut_lineage(rows.mapInArrow(write, "dim int, file string, n int"), "packs")
     .withColumn("stripe", F.pmod(F.xxhash64("file"), F.lit(stripes)).cast("int"))
     .write.partitionBy("stripe").parquet(manifest))
    return manifest, stripes


def _packs(manifest: str, stripe: int, dim: int) -> list[str]:
    """The stripe's files of one vector length; no folder: the stripe got none."""
    fs, path = filesystem(f"{manifest}/stripe={stripe}")
    if fs.get_file_info(path).type != pafs.FileType.Directory:
        return []
    files = pads.dataset(path, format="parquet", filesystem=fs).to_table().to_pandas()
    return sorted(files[files.dim == dim].file)


def _dealt(anchors: DataFrame, stripes: int, blocks: int):
    """Each anchor once per stripe, grouped by block, stripe and vector length."""
    spread = anchors.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    return spread.repartition(2 * blocks * stripes, "block", "stripe").groupBy("dim", "block", "stripe")


def _vectors(pdf: pd.DataFrame) -> np.ndarray:
    return np.array(pdf.vec.tolist(), np.int64).reshape(len(pdf), int(pdf.dim.iloc[0]))


def _first(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` of each group; a group holds at most k rows of each stripe."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, least_percent: int = 80,
                   id_col: str = "id", label_col: str = "label", vec_col: str = "vec",
                   block_rows: int = 256, stripe_rows: int = 1 << 18) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Both inputs have an integer id, an integer label and an array of integers. An
    anchor's positives are the ``positives`` highest inner products among rows of
    its label with another id; for each, the first ``negatives`` rows of other
    labels with least_percent * positive <= 100 * negative <= 100 * positive.
    Higher scores come first, ties by smaller id.

    - Rows without an id, a label or a vector, or with a null component, take no part.
    - Rows repeated among the candidates are found as often; an anchor that is
      repeated with the same label and vector counts once.
    - Vectors of different lengths don't meet; empty vectors score 0.
    - A positive without a fitting negative gives no row; with fewer, all of them.
    - An empty table gives an empty result; other columns play no part.
    - Scores beyond a long are held at its ends.
    """
    spark = rows.sparkSession
    folder = fresh_path(spark, "kronecker")
    rows = _rows(rows, id_col, label_col, vec_col)
    anchors = _rows(anchors, id_col, label_col, vec_col).distinct().withColumn("dim", F.size("vec"))
    anchors = cut_lineage(anchors.withColumn("no", F.xxhash64("vec")), "anchors")
    n_anchors, low, high = anchors.agg(F.count("*"), F.min(F.array_min("vec")), F.max(F.array_max("vec"))).first()
    blocks = max(1, -(-n_anchors // block_rows))
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("id", "label", "no"), F.lit(blocks)).cast("int"))
    manifest, stripes = _pack_rows(rows, low or 0, high or 0, folder, stripe_rows, rows.count())

    def find_positives(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, stripe = int(pdf.dim.iloc[0]), int(pdf.stripe.iloc[0])
        vec, own, label = _vectors(pdf), pdf.id.to_numpy(np.int64), pdf.label.to_numpy(np.int64)
        found = [(np.zeros(0, np.int64),) * 2 for _ in own]
        for name in _packs(manifest, stripe, dim):
            pack = Pack.load(name)
            for lab in np.unique(label):
                a, b = np.searchsorted(pack.labels, [lab, lab + 1]).tolist()
                if a < b:
                    mine = np.flatnonzero(label == lab)
                    score = pack.scores(vec[mine], a, b)
                    least = np.array([found[i][1][-1] if len(found[i][1]) == positives else _FAR.min for i in mine])
                    ok = (pack.ids[a:b] != own[mine, None]) & (score >= least[:, None])
                    for i, new in zip(mine, best(score, ok, pack.ids[a:b], positives)):
                        found[i] = merge(found[i], new, positives)
        return pd.DataFrame([(*key, int(p), int(s)) for key, f in zip(zip(own, label, pdf.no), found) for p, s in zip(*f)],
                            columns=["id", "label", "no", "positive_id", "positive_score"]).astype("int64")

    key = ["id", "label", "no"]
    near = (_dealt(anchors, stripes, blocks)
            .applyInPandas(find_positives, "id long, label long, no long, positive_id long, positive_score long"))
    near = _first(near, key, [F.desc("positive_score"), F.asc("positive_id")], positives)
    # At most ``positives`` entries an anchor. A repeated positive is a row of its own.
    near = near.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("near"))
    asked = cut_lineage(anchors.join(near, key), "positives")

    def find_negatives(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, stripe = int(pdf.dim.iloc[0]), int(pdf.stripe.iloc[0])
        vec, label = _vectors(pdf), pdf.label.to_numpy(np.int64)
        own = pdf.id.to_numpy(np.int64)
        near = [[(int(p["positive_id"]), int(p["positive_score"]), int(p["rank"])) for p in ps] for ps in pdf.near]
        found = [[(np.zeros(0, np.int64),) * 2 for _ in ps] for ps in near]
        for name in _packs(manifest, stripe, dim):
            pack = Pack.load(name)
            score = pack.scores(vec)
            other = (pack.labels != label[:, None]) & (pack.ids != own[:, None])
            for j in range(positives):
                mine = np.array([i for i, ps in enumerate(near) if len(ps) > j and ps[j][1] >= 0], np.int64)
                if not len(mine):
                    continue
                high = np.array([near[i][j][1] for i in mine])
                low = np.array([-(-least_percent * near[i][j][1] // 100) for i in mine])
                have = [found[i][j][1] for i in mine]
                low = np.maximum(low, [h[-1] if len(h) == negatives else _FAR.min for h in have])
                part = score[mine]
                ok = other[mine] & (part >= low[:, None]) & (part <= high[:, None])
                for i, new in zip(mine, best(part, ok, pack.ids, negatives)):
                    found[i][j] = merge(found[i][j], new, negatives)
        return pd.DataFrame([(*key, *p, int(c), int(s)) for key, ps, fs in zip(zip(own, label, pdf.no), near, found)
                             for p, f in zip(ps, fs) for c, s in zip(*f)],
                            columns=["id", "label", "no", "positive_id", "positive_score", "place", "negative_id", "negative_score"]).astype("int64")

    hard = (_dealt(asked, stripes, blocks)
            .applyInPandas(find_negatives, "id long, label long, no long, positive_id long, positive_score long, place long, negative_id long, negative_score long"))
    hard = _first(hard, [*key, "place"], [F.desc("negative_score"), F.asc("negative_id")], negatives)
    return hard.select(F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
