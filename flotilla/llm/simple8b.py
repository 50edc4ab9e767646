"""Simple-8b: integers packed into 64-bit words, vectorised both ways.

A word holds a 4-bit selector (its top bits) and 60 bits of data. Selectors
1 to 14 say how many integers of which width follow; selector 0 is an escape
whose data is the place of one integer in the block's exception list (for
values of more than 60 bits). A block packs a fixed count of integers on its
own, so blocks are encoded side by side, and the offset of a block's first
word finds it without reading the others.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
ESCAPE = 0
#: Selector -> (integers in the word, bits of each); the escape holds one.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0], np.int64)
WIDTHS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0], np.int64)
_DATA = np.uint64((1 << 60) - 1)


def _choose(values: np.ndarray) -> np.ndarray:
    """Selector of the fullest word that can begin at each place of (blocks, BLOCK)."""
    rows, width = values.shape
    choice = np.full(values.shape, 14, np.uint8)
    choice[values > _DATA] = ESCAPE
    for selector in range(13, 0, -1):
        count, bits = int(COUNTS[selector]), int(WIDTHS[selector])
        ok = np.ones((rows, width + count), bool)
        np.less(values, np.uint64(1 << bits), out=ok[:, :width])  # beyond the end: padding, fits
        if not ok[:, :width].any():
            break  # wider counts have narrower integers
        span = 1
        while span < count:  # ok[i] becomes: ok for i .. i + span - 1
            step = min(span, count - span)
            ok[:, :-step] &= ok[:, step:]
            span += step
        choice[ok[:, :width]] = selector
    return choice


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, exceptions, first exception of each block)."""
    n = len(values)
    blocks = -(-n // block)
    if not blocks:
        empty = np.zeros(0, np.uint64)
        return empty, empty, empty, empty
    grid = np.zeros(blocks * block, np.uint64)
    grid[:n] = values
    grid = grid.reshape(blocks, block)
    choice = _choose(grid)
    left = np.full(blocks, block, np.int64)
    left[-1] = n - (blocks - 1) * block
    # All blocks take their next word at the same time.
    at, active, rows, places = np.zeros(blocks, np.int64), np.arange(blocks), [], []
    while len(active):
        here = at[active]
        rows.append(active)
        places.append(here)
        at[active] = here + COUNTS[choice[active, here]]
        active = active[at[active] < left[active]]
    step = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    row, place = np.concatenate(rows), np.concatenate(places)
    order = np.lexsort((step, row))
    row, place = row[order], place[order]
    selector = choice[row, place]
    words = selector.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([grid, np.zeros((blocks, 60), np.uint64)], axis=1)
    for s in range(1, 15):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            bits = np.uint64(WIDTHS[s])
            for j in range(int(COUNTS[s])):
                words[mine] |= padded[row[mine], place[mine] + j] << (bits * np.uint64(j))
    escaped = np.flatnonzero(selector == ESCAPE)
    first_exception = np.searchsorted(row[escaped], np.arange(blocks)).astype(np.uint64)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64) - first_exception[row[escaped]]
    return words, np.searchsorted(row, np.arange(blocks)).astype(np.uint64), grid[row[escaped], place[escaped]], first_exception


def decode(words: np.ndarray, first_word: np.ndarray, exceptions: np.ndarray, first_exception: np.ndarray,
           n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` integers of :func:`encode`."""
    if not n:
        return np.zeros(0, np.uint64)
    blocks = len(first_word)
    selector = (words >> np.uint64(60)).astype(np.intp)
    counts = COUNTS[selector]
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.zeros(int(ends[-1]), np.uint64)
    data = words & _DATA
    for s in range(1, 15):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            bits, mask = np.uint64(WIDTHS[s]), np.uint64((1 << int(WIDTHS[s])) - 1)
            for j in range(int(COUNTS[s])):
                out[starts[mine] + j] = (data[mine] >> (bits * np.uint64(j))) & mask
    escaped = np.flatnonzero(selector == ESCAPE)
    if len(escaped):
        owner = np.searchsorted(first_word, escaped, side="right") - 1
        out[starts[escaped]] = exceptions[(data[escaped] + first_exception[owner]).astype(np.intp)]
    # The last word of a block may be padded beyond the block's integers.
    begin = starts[first_word.astype(np.intp)]
    held = np.diff(np.append(begin, len(out)))
    want = np.full(blocks, block, np.int64)
    want[-1] = n - (blocks - 1) * block
    if (held == want).all():
        return out
    keep = np.arange(len(out)) - np.repeat(begin, held) < np.repeat(want, held)
    return out[keep]
