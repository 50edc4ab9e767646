"""Secret scan: fixed patterns, and character Markov models of random strings
and of ordinary identifiers.

Two models of order 2 over the characters of tokens are trained from labelled
samples: random strings (label 1) and ordinary identifiers (label 0). A token
is a secret when the random model makes it likelier than the ordinary one by
more than the odds of the samples ask for (a log-likelihood ratio). Samples may
be given as a table, or taken from the texts themselves: what the patterns find
are random strings, other tokens ordinary identifiers if no letter follows a digit
in them (the rest has no label).

Every text is a sample and every text is scanned; counting and scanning only map
over the rows. What reaches the driver is the counts of character triples, whose
number the alphabet bounds (2 * 69 ** 3), whatever the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from flotilla.llm.shared import whole_row

#: Characters of tokens; code 0 is a token's edge.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SIZE = len(ALPHABET) + 1
_CODE = np.zeros(256, np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, SIZE)
EDGE = "\0\0"
BLOCK = 1 << 16

#: Letters of either case, A-Z alone (no folding of other alphabets).
_WORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w).replace("?", "_?")
                  for w in ("password", "passwd", "secret", "token", "api?key"))
ASSIGN = re.compile(rf"""({_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # a run is whole, so a shorter one holds no match
HEX = re.compile(r"[0-9a-f]{32,}")
#: In the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "markov")
SPANS = "array<struct<kind: string, start: int, end: int, score: double>>"
_TOKENS = "[A-Za-z0-9+/_.=-]{%d,}"
_TRIM = "./-_"
_MIXED = re.compile("[0-9][A-Za-z]")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, secret value) of the fixed patterns, by start and kind."""
    out = [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), kind, m[0]) for kind, pattern in ((1, ACCESS), (2, HEX)) for m in pattern.finditer(text)]
    return sorted(out)


def tokens(text: str, taken: list[tuple], pattern: re.Pattern, least: int) -> list[tuple[int, int]]:
    """(start, end) of tokens outside the ascending spans ``taken``, without the
    punctuation around them."""
    out, at = [], 0
    reach = 0  # the furthest end of the spans that begin before a token's end
    for m in pattern.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if reach > m.start():
            continue
        token = m[0]
        start = m.start() + len(token) - len(token.lstrip(_TRIM + "="))
        end = m.end() - len(token) + len(token.rstrip(_TRIM))
        if end - start >= least:
            out.append((start, end))
    return out


def _triples(names: list[str]) -> Iterator[np.ndarray]:
    """Codes of the character triples that end at each character of the tokens, in
    blocks of bounded size; -1 at an edge."""
    last = np.zeros(2, np.int64)
    stream = EDGE.join(names)
    for a in range(0, len(stream), BLOCK):
        codes = np.concatenate([last, _CODE[np.frombuffer(stream[a:a + BLOCK].encode(), np.uint8)]])
        last = codes[-2:]
        yield np.where(codes[2:] > 0, (codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:], -1)


@dataclass(frozen=True)
class SecretModel:
    ratio: np.ndarray   # log-likelihood ratio of each triple
    least: float        # what a token's sum must reach; infinite without samples of both kinds
    samples: tuple[int, int]  # ordinary, random

    def score(self, names: list[str]) -> list[float]:
        """Log-likelihood ratio of each token."""
        if not names:
            return []
        if sum(map(len, names)) > 4 * BLOCK and len(names) > 1:
            return [s for name in names for s in self.score([name])]
        if len(names) == 1:
            return [float(sum(self.ratio[t[t >= 0]].sum() for t in _triples(names)))]
        triples = np.concatenate(list(_triples(names)))
        values = np.where(triples >= 0, self.ratio[triples], 0.0)
        starts = np.cumsum([0] + [len(n) + len(EDGE) for n in names[:-1]])
        return np.add.reduceat(values, starts).tolist()

    def find(self, text: str, pattern: re.Pattern, least_chars: int) -> list[dict]:
        """All spans of a text: the patterns', and the tokens that look random."""
        fixed = base_spans(text)
        out = [(s, e, k, None) for s, e, k, _ in fixed]
        if np.isfinite(self.least):
            found = tokens(text, fixed, pattern, least_chars)
            out += [(s, e, 3, x) for (s, e), x in zip(found, self.score([text[s:e] for s, e in found])) if x >= self.least]
        return [{"kind": KINDS[k], "start": s, "end": e, "score": x} for s, e, k, x in sorted(out, key=lambda r: r[:3])]


def _from_texts(least_chars: int) -> Callable:
    """Samples of a text: the patterns' values (assigned ones only with a digit) and other tokens in which no letter follows a digit."""
    pattern = re.compile(_TOKENS % least_chars)

    def of(text: str, _) -> tuple[list[str], list[str]]:
        fixed = base_spans(text)
        ordinary = [text[s:e] for s, e in tokens(text, fixed, pattern, least_chars)] if fixed else pattern.findall(text)
        if _MIXED.search(text):
            ordinary = [t for t in ordinary if not _MIXED.search(t)]
        return ordinary, [v for _, _, kind, v in fixed if kind or any(c.isdigit() for c in v)]
    return of


def _given(text: str, label) -> tuple[list[str], list[str]]:
    token = re.sub("[^A-Za-z0-9+/_.=-]", "", text)
    return ([], [token]) if label else ([token], [])


def _fit(rows: DataFrame, samples_of: Callable, odds: float) -> SecretModel:
    """Count the triples of both kinds in the tasks that read the rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, names = np.zeros((2, SIZE ** 3), np.int64), [0, 0]
        held: list[list[str]] = [[], []]
        size = [0, 0]

        def flush(label: int) -> None:
            for t in _triples(held[label]):
                t = t[t >= 0]
                grams[label] += np.bincount(t, minlength=SIZE ** 3) if len(t) > SIZE ** 2 else 0
                if len(t) <= SIZE ** 2:
                    np.add.at(grams[label], t, 1)
            names[label] += sum(map(bool, held[label]))
            held[label].clear()
            size[label] = 0

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label")):
                text = text.as_py()
                if text and label.is_valid:
                    for kind, more in enumerate(samples_of(text, label.as_py())):
                        held[kind] += more
                        size[kind] += sum(map(len, more)) + 2 * len(more)
                        if size[kind] >= BLOCK:
                            flush(kind)
        for kind in (0, 1):
            flush(kind)
            at = np.flatnonzero(grams[kind])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at) + 1, kind)), pa.array(np.append(at, -1)), pa.array(np.append(grams[kind][at], names[kind]))],
                                             names=["label", "gram", "n"])

    summed = rows.mapInArrow(count, "label long, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n")).toArrow()
    label, gram, n = (summed.column(c).to_numpy() for c in ("label", "gram", "n"))
    counts, samples = np.zeros((2, SIZE ** 3)), [0, 0]
    for kind in (0, 1):
        counts[kind][gram[(label == kind) & (gram >= 0)]] = n[(label == kind) & (gram >= 0)]
        samples[kind] = int(n[(label == kind) & (gram < 0)].sum())
    least = np.inf
    if all(samples):
        least = float(np.log(samples[0] / samples[1]) + np.log(odds))
    return SecretModel((_logs(counts[1]) - _logs(counts[0])).astype(np.float32), least, (samples[0], samples[1]))


def _logs(counts: np.ndarray, weight: float = 2.0) -> np.ndarray:
    """Log-probability of each character after the two before it, smoothed by the
    probability after one of them, and that by an even share."""
    three = counts.reshape(SIZE, SIZE, SIZE)
    two = three.sum(axis=0)
    after_one = (two + weight / len(ALPHABET)) / (two.sum(axis=1, keepdims=True) + weight)
    return np.log((three + weight * after_one) / (three.sum(axis=2, keepdims=True) + weight)).reshape(-1)


def fit(samples: DataFrame, text_col: str = "text", label_col: str = "label", odds: float = 1000.0) -> SecretModel:
    """Models of labelled samples: a token per row, label 1 (random) or 0 (ordinary).

    Rows without a text or a label are left out, characters outside the alphabet
    too. A token is found when its random origin is ``odds`` times likelier than
    its ordinary one, the samples' own odds counted in. Without samples of both
    kinds the model finds nothing.
    """
    rows = samples.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{label_col}`").cast("long").alias("label"))
    return _fit(rows, _given, odds)


def fit_texts(docs: DataFrame, text_col: str = "text", least_chars: int = 8, odds: float = 1000.0) -> SecretModel:
    """Models of the samples that whole texts give: the values the fixed patterns
    find are random (assigned ones only with a digit), other tokens of at least
    ``least_chars`` characters in which no letter follows a digit are ordinary
    identifiers. Every row counts, repeated ones too."""
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.lit(0).cast("long").alias("label"))
    return _fit(rows, _from_texts(least_chars), odds)


def scan(docs: DataFrame, model: SecretModel, text_col: str = "text", keep: list[Column] | None = None, least_chars: int = 16) -> DataFrame:
    """``row`` (all input columns, or those of ``keep``) and ``spans``, a row per row.

    ``spans`` are ordered by start, then kind. The kinds ``assign``, ``access`` and
    ``hex`` are the fixed patterns' matches (leftmost, not overlapping within a
    kind; an assignment from its keyword to the end of its value); ``markov`` are
    tokens of at least ``least_chars`` characters that overlap none of those and
    that the model finds, with their log-likelihood ratio as ``score``. Places
    are code points, ends exclusive.

    - Null and empty texts have no spans.
    - A very long text is scanned whole, in place; a token of any length is scored
      in blocks, so what is held is the text and its matches.
    - Repeated rows are scanned one by one; an empty table gives an empty result.
    - Other columns, whatever their names, are carried in ``row``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SIZE ** 3 numbers
    row = F.struct(*keep) if keep is not None else whole_row(docs)
    base = docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    pattern = re.compile(_TOKENS % least_chars)
    out = StructType([base.schema["row"], StructField("spans", StructType.fromDDL("s " + SPANS)["s"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            spans = [shared.value.find(t.as_py(), pattern, least_chars) if t.is_valid else [] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(spans, kind)], names=["row", "spans"])

    return base.mapInArrow(run, out)
