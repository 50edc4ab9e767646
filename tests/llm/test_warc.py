"""WARC round trip, and recovery from damage."""

import gzip
import hashlib
import random

import pytest

from flotilla.llm import warc


class File:
    def __init__(self, data):
        self.data, self.at = data, 0

    def size(self):
        return len(self.data)

    def seek(self, at):
        self.at = at

    def read(self, n):
        self.at += n
        return self.data[self.at - n:self.at]


def record(i, payload):
    return warc.record_bytes(i, f"http://h/{i}", payload, hashlib.sha1(payload).hexdigest(), None, "1970-01-01T00:00:00Z")


def scan(data):
    out = list(warc.salvage(warc.Source(File(data))))
    at = 0
    for kind, offset, length, _ in out:  # whole file covered, in order (a damaged member shows its range twice)
        assert offset in (at, at - length) or kind == "gap"
        at = max(at, offset + length)
    assert at == len(data)
    return [warc.urn_to_id(f.headers["warc-record-id"]) for k, _, _, f in out if k == "record"], [(o, n) for k, o, n, _ in out if k == "gap"]


def test_ids():
    for n in (0, 1, 7 << 40, (1 << 63) - 1, -1, -(1 << 63), None):
        assert warc.urn_to_id(f"<{warc.id_to_urn(n)}>") == n
    assert warc.urn_to_id(None) is None


@pytest.mark.parametrize("packed", [True, False])
def test_recovers_after_damage(packed):
    rng = random.Random(9)
    raw = [record(i, bytes(rng.randrange(256) for _ in range(rng.randrange(0, 4000)))) for i in range(30)]
    parts = [warc._member(r, 6) for r in raw] if packed else raw
    starts = [sum(map(len, parts[:i])) for i in range(31)]
    data = b"".join(parts)
    assert scan(data) == (list(range(30)), [])
    hurt = bytearray(data)
    hurt[starts[4] + len(parts[4]) // 2] ^= 0x55         # one byte of record 4
    hurt[starts[9]:starts[9] + 10] = b"\0" * 10          # the start of record 9
    assert scan(bytes(hurt)) == ([i for i in range(30) if i not in (4, 9)], [(starts[4], len(parts[4])), (starts[9], len(parts[9]))])
    cut = data[:starts[20] - 3] + data[starts[21] - 2:]  # a byte range lost across two records
    ids, gaps = scan(cut)
    assert set(range(30)) - set(ids) <= {19, 20} and 20 not in ids and gaps
    ids, gaps = scan(b"junk before" + data[:-7])
    assert ids[:29] == list(range(29)) and gaps[0] == (0, 11)
    assert scan(b"") == ([], []) and scan(b"nothing here") == ([], [(0, 12)])


def test_damage_inside_a_member_with_many_records():
    inner = bytearray(b"".join(record(i, b"x" * 500) for i in range(5)))
    inner[inner.find(b"x" * 500, 900) + 20] = 65  # record 1: its digest differs
    data = gzip.compress(bytes(inner)) + warc._member(record(9, b"y"), 6)
    out = list(warc.salvage(warc.Source(File(data))))
    assert [warc.urn_to_id(f.headers["warc-record-id"]) for k, _, _, f in out if k == "record"] == [0, 2, 3, 4, 9]
    assert [k for k, *_ in out].count("gap") == 1


def test_without_digest_the_end_is_checked():
    good = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    bad = good.replace(b"Content-Length: 3", b"Content-Length: 2")
    out = list(warc.salvage(warc.Source(File(bad + good))))
    assert [(k, o) for k, o, *_ in out] == [("gap", 0), ("record", len(bad))]
    row = warc.describe(out[1][3], True)
    assert row["payload"] == b"abc" and row["payload_bytes"] == 3


def read_back(spark, rows, **kw):
    df = spark.createDataFrame([(u, h, i, "s") for i, u, h in rows], "url string, html string, page_id long, sha1 string").repartition(3)
    manifest = warc.write_warc(df, **kw)
    read = warc.read_warc(manifest)
    assert warc.gaps(read).count() == 0
    return sorted(((warc.urn_to_id(r.record_id), r.target_uri, bytes(r.payload).decode() if r.payload is not None else None, r.payload_bytes,
                    r.payload_digest, r.record_type, warc.urn_to_id(r.refers_to)) for r in read.collect()), key=repr)


def test_round_trip(spark):
    big, other = "é" * 600, "x" * 999
    rows = [(1, "http://a", big), (5, "http://b", big), (3, None, big), (2, "u\r\nv", other), (4, "w", other), (6, "n", None), (7, "e", ""),
            (None, "none", big), (8, "long", "z" * 3_000_000)]
    sha = {t: hashlib.sha1((t or "").encode()).hexdigest() for _, _, t in rows}

    def want(i, u, h):
        revisit = h == big and i != 5
        size = len((h or "").encode())
        return (i, u.replace("\r", "%0D").replace("\n", "%0A") if u else None, None if revisit else (h or ""), size, sha[h], "revisit" if revisit else "response", 5 if revisit else None)

    assert read_back(spark, rows) == sorted((want(*r) for r in rows), key=repr)
    assert read_back(spark, rows, archive_bytes=1) == sorted((want(*r) for r in rows), key=repr)
    assert read_back(spark, []) == []


def test_repeated_ids(spark):
    big = "q" * 2000
    got = read_back(spark, [(3, "a", big), (3, "a", big), (1, "b", big), (None, "c", "k" * 1500), (None, "c", "k" * 1500)])
    assert [(r[0], r[5], r[6]) for r in got] == [(1, "revisit", 3), (3, "response", None), (3, "response", None), (None, "response", None), (None, "response", None)]


def test_long_urls(spark):
    rows = [(1, "http://h/" + "u" * 100_000, "a"), (2, "http://h/" + "\r\n" * 3_000_000, "b"), (3, "http://h/3", "c")]
    got = read_back(spark, rows)
    assert [(r[0], r[2], r[5]) for r in got] == [(1, "a", "response"), (2, "b", "response"), (3, "c", "response")]
    assert [r[1] for r in got] == [u.replace("\r", "%0D").replace("\n", "%0A") for _, u, _ in rows]


@pytest.mark.parametrize("packed", [True, False])
def test_header_of_any_length(packed):
    """Header ends around the borders of the steps in which it is read, and none at all."""
    sha = hashlib.sha1(b"p").hexdigest()
    own = len(warc.record_bytes(0, "", b"p", sha, None, "d").partition(b"\r\n\r\n")[0])
    raw = [warc.record_bytes(i, "u" * (k * (1 << 16) - own + d), b"p", sha, None, "d") for i, (k, d) in enumerate((k, d) for k in (1, 2, 16) for d in range(-6, 7))]
    data = b"".join(warc._member(r, 1) if packed else r for r in raw)
    assert scan(data) == (list(range(len(raw))), [])
    open_end = b"WARC/1.1\r\n" + b"x" * 200_000
    lost = warc._member(open_end, 1) if packed else open_end
    assert scan(data + lost) == (list(range(len(raw))), [(len(data), len(lost))])


def test_a_block_over_a_gibibyte():
    payload = bytes((1 << 30) + 1)
    member = warc._member(record(1, payload), 1)
    del payload
    (kind, offset, length, found), = warc.salvage(warc.Source(File(member)))
    assert (kind, offset, length) == ("record", 0, len(member)) and len(found.block) > 1 << 30
    assert scan(warc._member(record(2, b"x"), 1))[0] == [2]
    assert [k for k, *_ in warc.salvage(warc.Source(File(member)), 1 << 20)] == ["gap"]  # a limit of the caller's holds
