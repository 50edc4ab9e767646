"""Token ids of a corpus as Simple-8b files, in ascending document order.

A range exchange on (id, hash of the text, place in the input) orders the documents
over the tasks, so rows that share an id, or have none, still spread, equal ones too. Each task
streams its documents into one file of chunks; a chunk holds whole documents
and, for every Simple-8b block, the offset of its first word. File numbers
follow the range order; a document's place in the corpus is the number of ids
in all earlier files (a running sum over one row per file) plus its place in
its own file.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from flotilla.llm import simple8b
from flotilla.llm.shared import attempt_name, filesystem, one_task_per_row, open_output
from flotilla.session import cut_lineage, fresh_path

MAGIC = b"FLTOK8\x01\x00"
CHUNK_IDS = 1 << 20
SLICE_BYTES = 4 << 20
#: Pieces whose ids a task remembers before it forgets the rarer half.
CACHE_PIECES = 1_000_000
#: White space (of any alphabet) before a space: such a text isn't cut at its spaces.
_SPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"
_WIDE = _SPACE + " "
#: A line end beside white space: such a text is cut at its spaces alone.
_LINES = _SPACE + "\n|\n" + _SPACE
#: Stands for a line end before a piece; a text that holds it isn't cut.
LINE = "\x01"


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary shows each byte: printable
    Latin-1 characters stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts, by way of the ids of their pieces.

    The byte-level pattern never joins what stands on the two sides of a
    place where a space follows a character that isn't white space, so the ids
    of a text are those of its pieces between such places, in order. A line end
    between two characters that aren't white space is a token of its own, so
    texts are cut there too (the line end goes with what follows it). Pieces
    repeat much more than texts; the ids of the more frequent are remembered.
    A text that holds the string of a special token isn't cut: there the library
    finds the token wherever it stands.
    A new piece that is one word of Latin letters, with at most a full stop or
    comma after it, goes straight to the library's model, any other through
    the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores already
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.stops = {c: self.tokenizer.encode(c, add_special_tokens=False).ids for c in ".,"}
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.known: dict[str, int] = {}   # pieces after a space
        self.first: dict[str, int] = {}   # pieces at a text's begin
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start, self.count, self.hits = (np.zeros(1 << 14, np.int64) for _ in range(3))
        self.pieces = self.used = 0

    def _forget(self) -> None:
        """Keep the more frequent half of the pieces."""
        keep = np.sort(np.argpartition(self.hits[:self.pieces], self.pieces // 2)[self.pieces // 2:])
        place = np.full(self.pieces, -1, np.int64)
        place[keep] = np.arange(len(keep))
        start, n = self.start[keep], self.count[keep]
        ends = np.cumsum(n)
        self.flat = self.flat[np.arange(ends[-1]) + np.repeat(start - ends + n, n)]
        self.start, self.count, self.hits = ends - n, n, self.hits[keep] // 2
        self.pieces, self.used = len(keep), int(ends[-1])
        self.known, self.first = ({k: int(place[v]) for k, v in d.items() if place[v] >= 0} for d in (self.known, self.first))

    def _word(self, word: str, prefix: str) -> list[int]:
        if word.isascii():  # only the space is shown by another letter
            shown = self.letters[0x20] + word if prefix else word
        else:
            shown = (prefix + word).encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(shown)]

    def _ids(self, names: list[str], prefix: str) -> list[list[int]]:
        out, rest = [], []
        words: dict[str, dict[str, list[int]]] = {"": {}, " ": {}}  # by what stands before
        for x in names:
            before, lead = prefix, None
            if x[:1] == LINE:
                x, before, lead = x[1:], "", self.line
            last = x[-1:]
            word = x[:-1] if last in self.stops else x
            if word.isalpha() and (word.isascii() or max(word) < "\u0250"):
                ids = words[before].get(word)
                if ids is None:
                    known = self.known.get(word) if before else None
                    if known is None:
                        ids = self._word(word, before)
                    else:
                        at = int(self.start[known])
                        ids = self.flat[at:at + int(self.count[known])].tolist()
                    words[before][word] = ids
                if word is not x:
                    ids = ids + self.stops[last]
                out.append(lead + ids if lead else ids)
            else:
                rest.append((len(out), lead, before + x))
                out.append(None)
        for (i, lead, _), e in zip(rest, self.tokenizer.encode_batch_fast([r[2] for r in rest], add_special_tokens=False)):
            out[i] = lead + e.ids if lead else e.ids
        return out

    def _learn(self, names: list[str], where: dict[str, int], prefix: str) -> None:
        ids = self._ids(names, prefix)
        n = [len(x) for x in ids]
        total = sum(n)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.pieces + len(names) > len(self.start):
            self.start, self.count, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count, self.hits))
        self.flat[self.used:self.used + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
        new = slice(self.pieces, self.pieces + len(names))
        self.count[new] = n
        self.start[new] = self.used + np.cumsum(n) - n
        where.update(zip(names, range(self.pieces, self.pieces + len(names))))
        self.pieces += len(names)
        self.used += total

    def _codes(self, names: list[str], where: dict[str, int], prefix: str) -> np.ndarray:
        codes = np.fromiter(map(where.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(codes < 0)
        if len(new):
            self._learn(list({names[i] for i in new}), where, prefix)
            codes[new] = [where[names[i]] for i in new]
        return codes

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids of each text) by pieces. Texts are split, and equal pieces
        brought together, as columns: each distinct piece is looked up once."""
        parts = pc.split_pattern(texts, " ")
        values, first = parts.values, parts.offsets.to_numpy()
        codes = np.empty(len(values), np.int64)
        is_head = np.zeros(len(values), bool)
        is_head[first[:-1]] = True
        codes[is_head] = self._codes(values.take(pa.array(first[:-1])).to_pylist(), self.first, "")
        pieces = values.filter(pa.array(~is_head)).dictionary_encode()
        known = self._codes(pieces.dictionary.to_pylist(), self.known, " ")
        codes[~is_head] = known[pieces.indices.to_numpy()]
        self.hits[:self.pieces] += np.bincount(codes, minlength=self.pieces)
        n = self.count[codes]
        ends = np.cumsum(n)
        ids = self.flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[codes] - ends + n, n)]
        return ids, np.diff(np.append(0, ends)[first])

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids of each text)."""
        if self.pieces > CACHE_PIECES:
            self._forget()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())

        def holds(found: pa.Array) -> np.ndarray:
            return found.to_numpy(zero_copy_only=False)

        whole = holds(pc.match_substring_regex(texts, _WIDE))
        for name in (*self.special, LINE):
            whole = whole | holds(pc.match_substring(texts, name))
        kind = np.where(whole, 2, holds(pc.match_substring_regex(texts, _LINES)).astype(np.int64))
        ways = (lambda t: self._cut(pc.replace_substring(t, "\n", " " + LINE)), self._cut, self._whole)
        if len(texts) and (kind == kind[0]).all():
            return ways[kind[0]](texts)
        # The texts of each kind, in their places among the others.
        lengths = np.zeros(len(texts), np.int64)
        found = {}
        for k in np.unique(kind).tolist():
            found[k], lengths[kind == k] = ways[k](texts.filter(pa.array(kind == k)))
        owner = np.repeat(kind, lengths)
        out = np.empty(len(owner), np.uint32)
        for k, ids in found.items():
            out[owner == k] = ids
        return out, lengths


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The worker's encoder: what it remembers serves the worker's later tasks too."""
    return Encoder(path)


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each document."""
    total = lengths + 1
    ends = np.cumsum(total)
    out = np.empty(int(ends[-1]) if len(ends) else 0, ids.dtype)
    is_end = np.zeros(len(out), bool)
    is_end[ends - 1] = True
    out[is_end] = end_id
    out[~is_end] = ids
    return out, total


def pack_chunk(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """[documents, ids, blocks, words, exceptions] and the arrays they count."""
    words, first, odd, first_odd = simple8b.encode(ids.astype(np.uint64))
    return b"".join(x.tobytes() for x in (
        np.array([len(doc_ids), len(ids), len(first), len(words), len(odd)], np.uint64),
        np.array([0 if d is None else d for d in doc_ids], np.int64), np.array([d is None for d in doc_ids], np.uint8),
        lengths.astype(np.uint64), first, first_odd, odd, words))


def read_chunks(f) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, ids of each document, all ids) of each chunk of a stream."""
    def take(n: int, kind) -> np.ndarray:
        raw = f.read(n * np.dtype(kind).itemsize)
        if len(raw) != n * np.dtype(kind).itemsize:
            raise EOFError("token file ends within a chunk")
        return np.frombuffer(raw, kind)

    if f.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    while raw := f.read(40):
        docs, n, blocks, n_words, n_odd = (int(x) for x in np.frombuffer(raw, np.uint64))
        doc_ids, null, lengths = take(docs, np.int64), take(docs, np.uint8), take(docs, np.uint64)
        first, first_odd, odd, words = take(blocks, np.uint64), take(blocks, np.uint64), take(n_odd, np.uint64), take(n_words, np.uint64)
        yield ([None if z else int(d) for d, z in zip(doc_ids, null)], lengths.astype(np.int64),
               simple8b.decode(words, first, odd, first_odd, n))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, pa.Array]]:
    """Runs of rows with a bounded amount of text (or one long text); null is the empty text."""
    texts = batch.column(1).cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.column(0).slice(begin, end - begin).to_pylist(), texts.slice(begin, end - begin)
        begin = end


def write_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Write the ids of all documents; returns the manifest (file_no, file, n_docs, n_ids, base).

    ``base`` is the number of ids in all earlier files. ``tokenizer`` is the
    path of a byte-level tokenizer file that every worker can open (it comes
    with the installation). Null text is empty: its document is ``end_id``
    alone. Documents are in ascending order of id, nulls first, rows that share
    an id by their text's hash. An empty table writes no file. A special token's
    string in a text is that token, as in the library's plain call. A long text is
    encoded whole; other columns, whatever their names, play no part.
    """
    folder = fresh_path(docs.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, out, name = None, None, None
        n_docs = n_ids = 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def flush() -> None:
            out.write(pack_chunk([d for h in held for d in h[0]], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])))
            held.clear()

        for batch in batches:
            for doc_ids, texts in _slices(batch):
                if out is None:
                    model, name = encoder(tokenizer), attempt_name(folder, "ids", ".tok8")
                    out = open_output(name)
                    out.write(MAGIC)
                ids, lengths = with_end(*model.encode(texts), end_id)
                held.append((doc_ids, lengths, ids))
                n_docs, n_ids = n_docs + len(doc_ids), n_ids + len(ids)
                if sum(len(h[2]) for h in held) >= CHUNK_IDS:
                    flush()
        if out is not None:
            if held:
                flush()
            out.close()
        rows = [] if out is None else [(TaskContext.get().partitionId(), name, n_docs, n_ids)]
        yield pa.RecordBatch.from_pylist([dict(zip(("file_no", "file", "n_docs", "n_ids"), r)) for r in rows], schema=pa.schema(
            [("file_no", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    order = ("id", F.xxhash64("text"), F.monotonically_increasing_id())
    manifest = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                           .mapInArrow(write, "file_no int, file string, n_docs long, n_ids long"), "token-files")
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read_tokens(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """A row per document of the files: doc_id, start, n_tokens, ids_crc32 (of the
    ids as little-endian unsigned 32-bit integers) and, if asked for, the ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    fields = [(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")] + [("ids", pa.list_(pa.int64()))] * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                fs, path = filesystem(name)
                with fs.open_input_stream(path, compression=None) as f:
                    for doc_ids, lengths, ids in read_chunks(f):
                        ids = ids.astype("<u4")
                        at = np.concatenate([[0], np.cumsum(lengths)])
                        row = {"doc_id": doc_ids, "start": at[:-1] + base, "n_tokens": lengths,
                               "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:])]}
                        if with_ids:
                            row["ids"] = [ids[a:b].astype(np.int64) for a, b in zip(at, at[1:])]
                        yield pa.RecordBatch.from_arrays([pa.array(row[n], t) for n, t in fields], names=[n for n, _ in fields])
                        base += int(at[-1])

    return one_task_per_row(manifest.select("file", "base")).mapInArrow(read, schema)
