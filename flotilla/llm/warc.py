"""WARC archives: a writer with revisit records and a reader that salvages.

The writer turns rows into records, one gzip member each, in archives of a
bounded size. Of rows with equal payloads the one with the largest id is the
response and the others revisit it: a per-digest maximum, pre-aggregated, so
a payload shared by a third of the rows costs a row per task.

The reader checks what it reads (gzip checksum, version line, lengths, block
digest). After a failed check it searches for the next valid gzip member or
version line, goes on from there and logs the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from flotilla.llm.shared import attempt_name, filesystem, one_task_per_row, open_output
from flotilla.session import cut_lineage, fresh_path

VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
GZIP = b"\x1f\x8b\x08"
#: A header is read in steps of this size, until it ends.
HEADER_STEP = 1 << 16
CHUNK = 1 << 20
#: No value of a column is as large, so every block the writer makes is smaller.
MAX_BLOCK = (1 << 31) + HEADER_STEP

RECORD_SCHEMA = ("archive string, kind string, offset long, length long, reason string, record_type string, record_id string, "
                 "target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary")
_ARROW = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
                    for n, t in (x.split() for x in RECORD_SCHEMA.split(", "))])


# --- ids and digests ---------------------------------------------------------

def id_to_urn(n: int | None) -> str:
    """A version 8 UUID that holds a 64-bit id (or says that there is none)."""
    if n is None:
        return f"urn:uuid:{uuid.UUID(int=(1 << 127) | (8 << 76) | (2 << 62))}"
    u = n & (1 << 64) - 1
    return f"urn:uuid:{uuid.UUID(int=(u >> 62) << 80 | (8 << 76) | (2 << 62) | (u & (1 << 62) - 1))}"


def urn_to_id(urn: str | None) -> int | None:
    if not urn:
        return None
    v = uuid.UUID(urn.strip("<>")[len("urn:uuid:"):]).int
    if v >> 127:
        return None
    u = (v >> 80 & 3) << 62 | v & (1 << 62) - 1
    return u - (1 << 64) if u >> 63 else u


def _base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _hex(label: str | None) -> str | None:
    """Bare lower-case hex of a ``sha1:`` label (base32, as written here, or hex)."""
    if not label or not label.lower().startswith("sha1:"):
        return None
    value = label[5:]
    try:
        return base64.b32decode(value.upper()).hex() if len(value) == 32 else bytes.fromhex(value).hex()
    except ValueError:
        return None


# --- writing -----------------------------------------------------------------

def mark_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """(id, payload, sha1, refers_to, row): refers_to is null for responses."""
    payload = F.encode(F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")), "UTF-8")
    rest = F.struct(*[F.col(f"`{c}`").alias(c) for c in pages.columns if c != payload_col])
    base = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), payload.alias("payload"), rest.alias("row"))
    base = base.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    shared = cut_lineage(base.filter(F.col("size") >= min_bytes).groupBy("sha1", "size")
                         .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "warc-payloads")
    return (base.join(shared, ["sha1", "size"], "left")
            .select("id", "payload", "sha1", "row",
                    F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first")).alias("refers_to")))


def record_bytes(page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit's block is the HTTP head of the response, whose
    Content-Length keeps the size of the payload that isn't repeated."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    kind = "revisit" if refers_to is not None else "response"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{id_to_urn(page_id)}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{id_to_urn(refers_to)}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response",
              "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode(),
              "WARC-Block-Digest: " + _base32_sha1(block), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_revisit_bytes: int = 1000, archive_bytes: int = 64 << 20, level: int = 3,
               date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row; returns the written manifest (archive, records).

    - Payload: the column as UTF-8; null is the empty payload.
    - Of rows with equal payloads (SHA-1 and length) of at least
      ``min_revisit_bytes``, the one with the largest id is the response and
      the others revisit it. Rows repeated under that id are responses too.
      A group without any id is all responses; null ids revisit others.
    - A null url leaves the target out; line ends in a url are escaped.
    - An empty table writes no archive.
    """
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    marked = mark_revisits(pages, id_col, payload_col, min_revisit_bytes)
    rows = marked.select("id", F.col("row")[url_col].alias("url"), "payload", "sha1", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, size, n = None, None, 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for r in zip(*(batch.column(c) for c in ("id", "url", "payload", "sha1", "refers_to"))):
                page_id, url, payload, sha1, refers = (x.as_py() for x in r)
                if out is None:
                    name, size, n = attempt_name(folder, "pages", ".warc.gz"), 0, 0
                    out = open_output(name)
                data = _member(record_bytes(page_id, url, payload, sha1, refers, date), level)
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((name, n))
                    out = None
        if out is not None:
            out.close()
            done.append((name, n))
        yield pa.RecordBatch.from_pydict({"archive": pa.array([d[0] for d in done], pa.string()),
                                          "records": pa.array([d[1] for d in done], pa.int64())})

    return cut_lineage(rows.mapInArrow(write, "archive string, records long"), "warc-manifest")


# --- reading -----------------------------------------------------------------

class Source:
    """Random reads of a file through one cached window."""

    def __init__(self, f):
        self.f, self.size, self.at, self.window = f, f.size(), 0, b""
        self.blank = (0, -1)

    def get(self, offset: int, n: int) -> bytes:
        n = max(0, min(n, self.size - offset))
        if n == 0:
            return b""
        if offset < self.at or offset + n > self.at + len(self.window):
            self.f.seek(offset)
            self.at, self.window = offset, self.f.read(max(n, min(CHUNK, self.size - offset)))
        return self.window[offset - self.at:offset - self.at + n]


@dataclass
class Found:
    headers: dict[str, str]
    block: bytes
    length: int


class Damaged(Exception):
    pass


def _headers(raw: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    last = None
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in " \t" and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            out[last] = value.strip()
    return out


def blank_line(src, offset: int) -> int:
    """Where the first blank line from ``offset`` on is; the end if there is none.
    The answer holds for every offset up to it, so bytes are searched once."""
    begin, end = src.blank
    if begin <= offset <= end:
        return end
    at, end = offset, src.size
    while at < src.size:
        chunk = src.get(at, HEADER_STEP)
        if (i := chunk.find(b"\r\n\r\n")) >= 0:
            end = at + i
            break
        at += max(1, len(chunk) - 3)
    src.blank = (offset, end)
    return end


def parse_record(src, offset: int, max_bytes: int) -> Found:
    """The record at ``offset`` of ``src``; raises Damaged when a check fails."""
    if not src.get(offset, HEADER_STEP).startswith(VERSIONS):
        raise Damaged("no version line")
    end = blank_line(src, offset) - offset
    if offset + end == src.size:
        raise Damaged("header without an end")
    h = _headers(src.get(offset, end))
    if not h.get("content-length", "").isascii() or not h.get("content-length", "").isdigit():
        raise Damaged("no content length")
    n, at = int(h["content-length"]), offset + end + 4
    if n > max_bytes:
        raise Damaged("record over the size limit")
    if at + n > src.size:
        raise Damaged("truncated block")
    block = src.get(at, n)
    if (want := _hex(h.get("warc-block-digest"))) is not None and hashlib.sha1(block).hexdigest() != want:
        raise Damaged("block digest differs")
    tail = src.get(at + n, 4)
    if tail != b"\r\n\r\n":
        if want is None:
            raise Damaged("no record end")
        tail = b""
    return Found(h, block, end + 4 + n + len(tail))


class Bytes:
    """The same reads over bytes in memory."""

    def __init__(self, data: bytes):
        self.data, self.size, self.blank = data, len(data), (0, -1)

    def get(self, offset: int, n: int) -> bytes:
        return self.data[offset:offset + n]


def inflate(src: Source, offset: int, max_bytes: int) -> tuple[bytes, int]:
    """(data, compressed length) of the gzip member at ``offset``. The header of a
    record at its start doesn't count towards ``max_bytes``, however long it is."""
    z, out, size, at = zlib.decompressobj(31), [], 0, offset
    head, tail = 0, b""  # bytes of that header, None until it ends
    try:
        while not z.eof:
            # What the member doesn't use is read again for the next one, from the window.
            chunk = src.get(at, 1 << 16)
            if not chunk:
                raise Damaged("truncated member")
            at += len(chunk)
            while chunk and not z.eof:
                out.append(z.decompress(chunk, CHUNK))
                if not size and out[-1].startswith(VERSIONS):
                    head = None
                if head is None:
                    i = (tail + out[-1]).find(b"\r\n\r\n")
                    head = size - len(tail) + i if i >= 0 else None
                    tail = (tail + out[-1])[-3:]
                size += len(out[-1])
                if head is not None and size > head + max_bytes + HEADER_STEP:
                    raise Damaged("member over the size limit")
                chunk = z.unconsumed_tail
    except zlib.error as e:
        raise Damaged(f"gzip: {e}") from None
    return b"".join(out), at - len(z.unused_data) - offset


def _starts_record(src: Source, offset: int) -> bool:
    """Whether a version line, or a member that begins with one, is at ``offset``."""
    raw = src.get(offset, 512)
    if raw.startswith(VERSIONS):
        return True
    if not raw.startswith(GZIP):
        return False
    try:
        return zlib.decompressobj(31).decompress(raw, 16).startswith(VERSIONS)
    except zlib.error:
        return False


def next_start(src, offset: int) -> int:
    """The next offset at which a record may begin; the end if there is none."""
    at = offset
    while at < src.size:
        chunk = src.get(at, CHUNK)
        hits, i = [], -1
        for mark in (GZIP, b"WARC/1."):
            i = chunk.find(mark)
            while i >= 0:
                hits.append(i)
                i = chunk.find(mark, i + 1)
        for i in sorted(hits):
            if _starts_record(src, at + i):
                return at + i
        if at + len(chunk) >= src.size:
            break
        at += max(1, len(chunk) - 16)
    return src.size


def salvage(src: Source, max_bytes: int = MAX_BLOCK) -> Iterator[tuple]:
    """('record', offset, length, Found) and ('gap', offset, length, reason) in
    file order; together they cover the whole file. A record inside a gzip
    member has the offset and length of its member."""
    at, gap, why = 0, None, ""
    while at < src.size:
        try:
            if src.get(at, 3) == GZIP:
                data, length = inflate(src, at, max_bytes)
                inner, pos, found, bad = Bytes(data), 0, [], ""
                while pos < inner.size:
                    try:
                        found.append(parse_record(inner, pos, max_bytes))
                        pos += found[-1].length
                    except Damaged as e:
                        bad = bad or str(e)
                        nxt = min((i for v in VERSIONS if (i := data.find(v, pos + 1)) >= 0), default=inner.size)
                        pos = nxt
                if not found:
                    raise Damaged(bad or "empty member")
                if gap is not None:
                    yield "gap", gap, at - gap, why
                    gap = None
                for f in found:
                    yield "record", at, length, f
                if bad:
                    yield "gap", at, length, bad + " (inside a member)"
            else:
                found = parse_record(src, at, max_bytes)
                length = found.length
                if gap is not None:
                    yield "gap", gap, at - gap, why
                    gap = None
                yield "record", at, length, found
            at += length
        except Damaged as e:
            if gap is None:
                gap, why = at, str(e)
            at = next_start(src, at + 1)
    if gap is not None:
        yield "gap", gap, src.size - gap, why


def describe(f: Found, with_payload: bool) -> dict:
    """The row of a record. The size and digest are those of the full payload:
    computed for a response, as its head says for a revisit."""
    head, sep, payload = f.block.partition(b"\r\n\r\n")
    http = sep and "application/http" in f.headers.get("content-type", "")
    if not http:
        payload, head = f.block, b""
    row = {"record_type": f.headers.get("warc-type"), "record_id": f.headers.get("warc-record-id"),
           "target_uri": f.headers.get("warc-target-uri"), "refers_to": f.headers.get("warc-refers-to")}
    if row["record_type"] == "revisit":
        n = _headers(head).get("content-length", "") if http else ""
        return row | {"payload_bytes": int(n) if n.isdigit() else None, "payload_digest": _hex(f.headers.get("warc-payload-digest")), "payload": None}
    return row | {"payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest(), "payload": payload if with_payload else None}


def read_warc(archives: DataFrame, archive_col: str = "archive", with_payload: bool = True,
              max_record_bytes: int = MAX_BLOCK) -> DataFrame:
    """Read the archives named in ``archives``, a task each.

    One row per record (kind 'record') and per quarantined byte range (kind
    'gap', with its offset, length and reason). Null names are passed over; an
    archive that can't be opened fails the job. A record whose block is over
    ``max_record_bytes`` is a gap; the default is more than any row can hold, so
    it never meets a record of :func:`write_warc`. A header has no limit.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = filesystem(name)
                rows, size = [], 0
                with fs.open_input_file(path) as f:
                    for kind, offset, length, what in salvage(Source(f), max_record_bytes):
                        row = {"archive": name, "kind": kind, "offset": offset, "length": length}
                        row |= {"reason": what} if kind == "gap" else describe(what, with_payload)
                        rows.append(row)
                        size += 200 + len(row.get("payload") or b"") + len(row.get("target_uri") or "")
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    names = archives.select(F.col(f"`{archive_col}`").cast("string").alias("archive")).filter("archive IS NOT NULL")
    return one_task_per_row(names).mapInArrow(read, RECORD_SCHEMA)


def gaps(read: DataFrame) -> DataFrame:
    """The log of quarantined byte ranges of :func:`read_warc`."""
    return read.filter("kind = 'gap'").select("archive", "offset", "length", "reason")


def archive_files(spark: SparkSession, folder: str, pattern: str = "*.warc*") -> DataFrame:
    """The archives below a folder, as input for :func:`read_warc`."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select(F.col("path").alias("archive"))
