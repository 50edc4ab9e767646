"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

A token is a run of letters, of digits or of other characters, so the marks
around a word are tokens of their own. Features are single tokens, pairs of
neighbours, and triples of token shapes (case, length class, repeat of the
token before, or the mark itself), hashed into a fixed number of weights; a
text's values are square roots of frequencies, a vector of length one.

The fit reads a bounded sample of the labelled rows (``max_rows``, picked by a
hash of the id) in one task; scoring is a map over whole texts with the weight
vector, of a fixed size, broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flotilla.llm.langid import _schema
from flotilla.llm.shared import whole_row
from flotilla.llm.text import _GRAM, _power, mix, slices

FEATURE_BITS = 20
#: Proximal parameters: learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5

_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = _LETTER
_VALUE = np.random.default_rng(0xF0).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[48:58] = _VALUE[48]  # digits are alike
_VALUE[_CLASS == _SPACE] = 0


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray  # 2 ** FEATURE_BITS
    bias: float
    rows: int


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes, shape hashes, tokens per text)."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    kind = _CLASS[raw]
    begin = kind != _SPACE
    begin[1:] &= kind[1:] != kind[:-1]
    starts = np.flatnonzero(begin)
    counts = np.diff(np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts])))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), counts
    first = int(starts[0])
    span = np.diff(np.append(starts, len(raw)))
    place = np.arange(first, len(raw)) - np.repeat(starts, span)
    body = raw[first:]
    at = starts - first
    hashes = mix(np.add.reduceat(_VALUE[body] * _power(int(span.max()))[place], at))
    length = np.add.reduceat((kind[first:] != _SPACE).astype(np.int64), at)
    upper = np.add.reduceat(((body >= 65) & (body <= 90)).astype(np.int64), at)
    case = np.where(upper == 0, 0, np.where((upper == length) & (length > 1), 2, 1))
    shape = (case * 4 + np.minimum(length, 12) // 4).astype(np.uint64)
    repeat = np.zeros(len(hashes), bool)
    repeat[1:] = hashes[1:] == hashes[:-1]
    shape = np.where(repeat, np.uint64(99), shape)
    marks = kind[starts] == _OTHER
    shape = np.where(marks, hashes, mix(shape + np.uint64(1000) * (kind[starts] == _DIGIT)))
    return hashes, shape, counts


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: (feature, value, features per text)."""
    hashes, shape, counts = tokens(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    parts, owners = [hashes], [owner]
    for values, n, salt in ((hashes, 2, 1), (shape, 3, 2)):
        if len(values) >= n:
            total = np.full(len(values) - n + 1, salt, np.uint64)
            for k in range(n):
                total += values[k:len(values) - n + 1 + k] * _GRAM[k]
            same = owner[n - 1:] == owner[:len(total)]
            parts.append(mix(total[same]))
            owners.append(owner[:len(total)][same])
    who = np.concatenate(owners).astype(np.uint64)
    key = (np.concatenate(parts) >> np.uint64(64 - FEATURE_BITS)) | who << np.uint64(FEATURE_BITS)
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(key)))
    who = (key[at] >> np.uint64(FEATURE_BITS)).astype(np.int64)
    total = np.bincount(who, times, len(texts))
    feature = (key[at] & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.uint32)
    return feature, np.sqrt(times / total[who]).astype(np.float32), np.bincount(who, minlength=len(texts))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int, seed: int = 7) -> tuple[np.ndarray, float]:
    """FTRL-proximal over sparse rows (feature, value, label); the last weight is the bias."""
    seen = np.unique(np.concatenate([r[0] for r in rows])) if rows else np.zeros(0, np.uint32)
    bias = len(seen)
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    short = [(np.append(np.searchsorted(seen, feature), bias), np.append(value.astype(np.float64), 1.0), label) for feature, value, label in rows]
    rng = np.random.default_rng(seed)

    def weights(zi, root):
        w = (np.copysign(L1, zi) - zi) / ((BETA + root) / ALPHA + L2)
        free = w[-1] if abs(zi[-1]) > L1 else -zi[-1] / ((BETA + root[-1]) / ALPHA + L2)
        w[np.abs(zi) <= L1] = 0.0
        w[-1] = free  # the bias isn't held at zero
        return w

    for _ in range(epochs):
        for r in rng.permutation(len(short)):
            i, x, label = short[r]
            ni = n[i]
            root = np.sqrt(ni)
            zi = z[i]
            w = weights(zi, root)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            ni += g * g
            z[i] = zi + g - (np.sqrt(ni) - root) / ALPHA * w
            n[i] = ni
    w = weights(z, np.sqrt(n))
    out = np.zeros(1 << FEATURE_BITS, np.float32)
    out[seen] = w[:-1]
    return out, float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality",
        max_rows: int = 8_000, updates: int = 16_000, max_epochs: int = 20) -> QualityModel:
    """Fit on at most about ``max_rows`` labelled documents.

    A document is in the sample when a hash of its id is below ``max_rows`` over
    the number of labels; with fewer labels all take part. The sample is passed
    over until about ``updates`` updates are made, at most ``max_epochs`` times. Rows without an id,
    a label (0 or 1) or text teach nothing; an id labelled both ways counts by
    its smaller label. Without any label the model scores everything 0.5.
    """
    marks = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
             .filter("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.min("label").alias("label")))
    total = marks.count()
    if not total:
        return QualityModel(np.zeros(1 << FEATURE_BITS, np.float32), 0.0, 0)
    part = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1_000_003)) < int(1_000_003 * min(1.0, max_rows / total))
    sample = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
              .filter(F.col("text").isNotNull()).filter(part if total > max_rows else F.lit(True))
              .join(marks.filter(part if total > max_rows else F.lit(True)), "id").select("id", "label", "text"))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, texts in slices(batch):
                feature, value, n = features(texts)
                cuts = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(begin, end - begin), batch.column("label").slice(begin, end - begin),
                     pa.array([feature[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]), pa.array([value[a:b].tobytes() for a, b in zip(cuts, cuts[1:])])],
                    names=["id", "label", "feature", "value"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            for i, label, feature, value in zip(*(b.column(k).to_pylist() for k in ("id", "label", "feature", "value"))):
                rows.append((i, np.frombuffer(feature, np.uint32), np.frombuffer(value, np.float32), label))
        rows.sort(key=lambda r: (r[0], r[1].tobytes()))  # the result doesn't depend on the order of arrival
        w, bias = train([r[1:] for r in rows], min(max_epochs, -(-updates // len(rows)))) if rows else (np.zeros(1 << FEATURE_BITS, np.float32), 0.0)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()]), pa.array([bias]), pa.array([len(rows)])], names=["w", "bias", "n"])

    from pyspark.sql.types import StructField, StructType
    kind = StructType([StructField("id", sample.schema["id"].dataType), *StructType.fromDDL("label int, feature binary, value binary").fields])
    model = sample.mapInArrow(sparse, kind).repartition(1).mapInArrow(learn, "w binary, bias double, n long").first()
    return QualityModel(np.frombuffer(model.w, np.float32), model.bias, model.n)


def judge(model: QualityModel, texts: list[bytes]) -> np.ndarray:
    feature, value, n = features(texts)
    owner = np.repeat(np.arange(len(texts)), n)
    dot = np.bincount(owner, model.weights[feature] * value, len(texts)) + model.bias
    return 1 / (1 + np.exp(-np.clip(dot, -35, 35)))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """``row`` (all input columns, or those of ``keep``) and ``score`` (0 to 1,
    higher: label 1 likelier), a row per row. Null and empty texts score the
    model's bias."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** FEATURE_BITS floats
    row = F.struct(*keep) if keep is not None else whole_row(docs)
    # The text travels to the worker once: in the row, or beside what is kept of it.
    base = docs.select(row.alias("row"), *[F.col(f"`{text_col}`").alias("text")] * (keep is not None))
    where = {"text": text_col, "within": "row"} if keep is None else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, texts in slices(batch, **where):
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(begin, end - begin), pa.array(judge(shared.value, texts))], names=["row", "score"])

    return base.mapInArrow(run, _schema(base, "row", "score double"))
