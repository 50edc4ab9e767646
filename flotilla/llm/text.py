"""Words and word n-grams of whole texts as 64-bit hashes, a slice of rows at a time.

A word is ``[^\\x20\\x09-\\x0D]+``; only A-Z are folded. A word's hash is a
polynomial over random 64-bit values of its bytes, finished with a mixer, so
a slice of many texts is hashed with a few array passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_rng = np.random.default_rng(0x5EED)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LETTER = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[65:91] = _LETTER[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER[_SPACE] = 0
_GRAM = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finisher."""
    h = h ^ (h >> np.uint64(30))
    h = h * _MIX1
    h = h ^ (h >> np.uint64(27))
    h = h * _MIX2
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        p = np.full(max(n, 2 * len(_powers)), _ODD, np.uint64)
        p[0] = 1
        _powers = np.cumprod(p, dtype=np.uint64)
    return _powers


#: Bytes of words that are runs of letters and digits (bytes over 127 are letters).
TERMS = np.where(np.array([c > 127 or chr(c).isalnum() for c in range(256)]), _LETTER, np.uint64(0))


def words(texts: list[bytes], letters: np.ndarray = _LETTER) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of each text). ``letters`` gives the
    value of each byte, 0 for what separates words."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = letters[raw] == 0
    begin = ~space
    begin[1:] &= space[:-1]
    starts = np.flatnonzero(begin)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, bounds))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    first = int(starts[0])
    length = np.diff(np.append(starts, len(raw)))
    place = np.arange(first, len(raw)) - np.repeat(starts, length)
    values = letters[raw[first:]] * _power(int(length.max()))[place]
    return mix(np.add.reduceat(values, starts - first)), counts


def _gram(hashes: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total += hashes[k:len(hashes) - n + 1 + k] * _GRAM[k]
    return mix(total ^ np.uint64(n))


def ngrams(hashes: np.ndarray, counts: np.ndarray, n: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hashes, number per text). With ``short`` a text of fewer words
    (but at least one) has its whole sequence as its only n-gram."""
    ends = np.cumsum(counts)
    starts = ends - counts
    out_counts = np.maximum(counts - n + 1, 0)
    grams = np.zeros(0, np.uint64)
    if len(hashes) >= n:
        all_grams = _gram(hashes, n)
        owner_end = np.repeat(ends, counts)
        grams = all_grams[np.arange(len(all_grams)) + n <= owner_end[:len(all_grams)]]
    if not short:
        return grams, out_counts
    few = np.flatnonzero((counts > 0) & (counts < n))
    if not len(few):
        return grams, out_counts
    at = np.cumsum(out_counts) - out_counts
    one = np.array([_gram(hashes[starts[i]:ends[i]], int(counts[i]))[0] for i in few], np.uint64)
    out_counts = out_counts.copy()
    out_counts[few] = 1
    return np.insert(grams, at[few], one), out_counts


def slices(batch: pa.RecordBatch, text: str = "text", within: str | None = None) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, end, UTF-8 texts) of runs of rows with a bounded amount of
    text, or one long text; null is the empty text. The text is a column, or a
    field of the struct column ``within``."""
    column = batch.column(within).field(text) if within else batch.column(text)
    begin, size, out = 0, 0, []
    for i, value in enumerate(column.cast(pa.large_binary())):
        raw = value.as_py() or b""
        if out and size + len(raw) > SLICE_BYTES:
            yield begin, i, out
            begin, size, out = i, 0, []
        out.append(raw)
        size += len(raw)
    if out:
        yield begin, batch.num_rows, out
    del column, out
    pa.default_memory_pool().release_unused()  # workers live on; what a batch took goes back


def distinct_per_text(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The grams of each text sorted and without repeats."""
    owner = np.repeat(np.arange(len(counts)), counts)
    g = grams.copy()
    ends = np.cumsum(counts)
    for a, b in zip((ends - counts).tolist(), ends.tolist()):
        g[a:b].sort()
    keep = np.ones(len(g), bool)
    keep[1:] = (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])
    return g[keep], np.bincount(owner[keep], minlength=len(counts))
