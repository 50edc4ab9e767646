"""Language identification with a bit-sliced Bloom filter of n-grams.

Each slot of one Bloom filter holds a bit per language, in as many 64-bit
words as the languages need; the slots of an
n-gram, and-ed, name every language that holds it. A text is judged by the
count of its n-grams under each language's bit, corrected for the rate at
which that language's slice answers falsely.

The filter is filled from counts over all training documents: an n-gram
enters a language's slice when at least a stated share of that language's
documents hold it and its share there is not far below its largest share in
any language. Counting is pre-aggregated per task; the slots are built by
Spark and only the filter itself, 4 MB per 64 languages, reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flotilla.llm.shared import whole_row
from flotilla.llm.text import mix, slices
from flotilla.session import cut_lineage

UNKNOWN = "und"
GRAM = 3
SLOT_BITS = 19
HASHES = 3
WORD = 64


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    slots: np.ndarray   # 2 ** SLOT_BITS masks of up to 64 languages; of more, a column of masks per 64
    false: np.ndarray   # rate of false answers per language
    usual: np.ndarray   # share of a training document's distinct n-grams that its language would hold without it

    def words(self) -> np.ndarray:
        """The masks as a row of 2 ** SLOT_BITS per 64 languages."""
        return self.slots[None] if self.slots.ndim == 1 else self.slots.T


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-cased code point of every letter, a space for all else."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every n-gram of letters and word ends, number per text, letters per text).

    Runs of other characters count as one word end; an n-gram of white space
    around its middle says nothing and is left out.
    """
    joined = b"\n".join(texts) + b"\n"
    points = np.frombuffer(joined.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t.decode("utf-8", "replace")) + 1 for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    low = _letters()[points]
    word = low != 32
    letters = np.bincount(owner[word], minlength=len(texts))
    keep = word.copy()
    keep[1:] |= word[:-1]  # the first of a run of others stays, as a word end
    low, owner = low[keep], owner[keep]
    if len(low) < GRAM:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64), letters
    key = np.zeros(len(low) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        key = key << np.uint64(21) | low[k:len(low) - GRAM + 1 + k].astype(np.uint64)
    ok = (owner[GRAM - 1:] == owner[:len(key)]) & (low[1:len(key) + 1] != 32)
    return mix(key[ok]), np.bincount(owner[:len(key)][ok], minlength=len(texts)), letters


def slots_of(keys: np.ndarray) -> list[np.ndarray]:
    """The HASHES slots of each key."""
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return [((keys >> np.uint64(SLOT_BITS * k)) & mask).astype(np.intp) for k in range(HASHES)]


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, documents), summed over a few million n-grams at a time, and
    with a null gram the sum of a language's."""
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def counts():
        for lang, parts in held.items():
            g, n = np.unique(np.concatenate(parts), return_counts=True)
            gram = pa.concat_arrays([pa.array(g.view(np.int64)), pa.nulls(1, pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), gram, pa.array(np.append(n, n.sum()))], names=["lang", "gram", "docs"])
        held.clear()

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for begin, end, texts in slices(batch):
            keys, n, _ = grams(texts)
            ends = np.cumsum(n)
            for lang, a, b in zip(langs[begin:end], ends - n, ends):
                own = np.unique(keys[a:b])
                held.setdefault(lang, []).append(own)
                size += len(own)
            if size > 2_000_000:
                yield from counts()
                size = 0
    yield from counts()


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_share: float = 0.02, near: float = 0.2) -> LanguageModel:
    """Fit on every row with a language.

    An n-gram is a language's when at least ``min_share`` of its documents hold
    it, and at least ``near`` times as large a share as in the language where
    it is most common. So a language has at most (n-grams per document /
    ``min_share``) of them. Any number of languages. Rows without a language or
    without text teach nothing.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    totals = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(totals))
    words = np.zeros((max(1, -(-len(languages) // WORD)), 1 << SLOT_BITS), np.uint64)
    usual = np.zeros(len(languages))
    if languages:
        of = spark.createDataFrame([(k, float(totals[k]), i) for i, k in enumerate(languages)], "lang string, total double, language int")
        share = (rows.mapInArrow(_document_counts, "lang string, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
                 .join(F.broadcast(of), "lang").select("gram", "language", (F.col("docs") / F.col("total")).alias("share"), ((F.col("docs") - 1) / F.col("total")).alias("others")))  # a row per language
        share = cut_lineage(share.filter(F.col("gram").isNull() | (F.col("share") >= min_share)), "language-grams")
        best = share.groupBy("gram").agg(F.max("share").alias("best"))
        chosen = share.join(best, "gram").filter(F.col("share") >= near * F.col("best"))
        sums = (share.filter("gram IS NULL").selectExpr("language", "share AS all", "0D AS held").union(chosen.filter(F.col("others") >= min_share).selectExpr("language", "0D", "share"))
                .groupBy("language").agg(F.sum("all").alias("all"), F.sum("held").alias("held")).collect())  # a row per language
        for r in sums:
            usual[r["language"]] = r["held"] / r["all"] if r["all"] else 0.0
        chosen = chosen.selectExpr("gram", f"language div {WORD} AS word", f"shiftleft(1L, language % {WORD}) AS mask")
        slot = "cast(shiftrightunsigned(gram, {}) & {} AS int)"
        each = ", ".join(slot.format(SLOT_BITS * k, (1 << SLOT_BITS) - 1) for k in range(HASHES))
        # At most 2 ** SLOT_BITS rows per word.
        filled = chosen.selectExpr("word", "mask", f"explode(array({each})) AS slot").groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()
        words[filled.column("word").to_numpy(), filled.column("slot").to_numpy()] = filled.column("mask").to_numpy().view(np.uint64)
    fill = np.array([((words[i // WORD] >> np.uint64(i % WORD)) & np.uint64(1)).mean() for i in range(len(languages))])
    return LanguageModel(languages, words[0] if len(words) == 1 else words.T, fill ** HASHES, usual)


def judge(model: LanguageModel, texts: list[bytes], least: float = 0.3) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(language, score, letters, n-grams, excess) of each text."""
    keys, n, letters = grams(texts)
    at, owner = slots_of(keys), np.repeat(np.arange(len(texts)), n)
    hits = np.zeros((len(texts), max(1, len(model.languages))))
    for w, slots in enumerate(model.words()):
        mask = np.full(len(keys), np.uint64(0xFFFFFFFFFFFFFFFF))
        for a in at:
            mask &= slots[a]
        for i in range(w * WORD, min((w + 1) * WORD, len(model.languages))):
            hits[:, i] = np.bincount(owner, (mask >> np.uint64(i % WORD)) & np.uint64(1), len(texts))
    false = model.false if len(model.languages) else np.zeros(1)
    true = np.maximum(hits - n[:, None] * false, 0) / (1 - np.minimum(false, 0.999))
    best = true.argmax(axis=1)
    top = true[np.arange(len(texts)), best]
    known = (letters > 0) & (len(model.languages) > 0)
    score = np.where(known & (n > 0), np.minimum(top / np.maximum(n, 1), 1.0), 0.0)
    excess = np.zeros(len(texts))
    if len(model.languages):
        excess = (true / np.maximum(n, 1)[:, None] - np.minimum(least, model.usual / 2)).max(axis=1)
    return [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], score, letters, n, excess


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[Column] | None = None, least: float = 0.3) -> DataFrame:
    """``row`` (all input columns, or those of ``keep``), ``lang_pred``, ``score``,
    ``letters``, ``n_grams`` and ``excess``, a row per row.

    ``score`` (0 to 1) is the share of the text's n-grams that the predicted
    language holds, corrected for false answers. Null texts and texts without a
    letter are ``und`` with score 0, and so is everything if nothing was
    learned. Ties go to the language first in the alphabet. ``excess`` is by how
    much the share of n-grams passes, in the language where it does so most, ``least`` or
    half of what that language usually holds of its documents, whichever is less.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** SLOT_BITS masks per 64 languages
    row = F.struct(*keep) if keep is not None else whole_row(docs)
    # The text travels to the worker once: in the row, or beside what is kept of it.
    base = docs.select(row.alias("row"), *[F.col(f"`{text_col}`").alias("text")] * (keep is not None))
    where = {"text": text_col, "within": "row"} if keep is None else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, texts in slices(batch, **where):
                lang, *more = judge(shared.value, texts, least)
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(begin, end - begin), pa.array(lang, pa.string()), *map(pa.array, more)],
                                                 names=["row", "lang_pred", "score", "letters", "n_grams", "excess"])

    return base.mapInArrow(run, _schema(base, "row", "lang_pred string, score double, letters long, n_grams long, excess double"))


def _schema(base: DataFrame, first: str, more: str):
    from pyspark.sql.types import StructType
    return StructType([base.schema[first], *StructType.fromDDL(more).fields])
