"""URL filter: a memory-mapped sorted array of 64-bit digests.

Each rule string (host and path) is hashed with xxhash64; the keys are kept
sorted in files, one per range of the key's top bits, beside the full rule
strings. A probe hashes every (host suffix, path prefix) of a url that could
be a rule (no suffix or prefix is longer than the longest of the rules, however
long the url is), finds the keys of a whole batch with a vectorised binary search
and confirms each hit against the stored string, so a digest collision never
decides a verdict.

The index is built by Spark (one task per key range, their number following the
number of rules) into the shared folder.
Tasks map the files read-only; a shared folder that isn't a file system path
is brought to the executors with ``SparkContext.addFile``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyarrow import fs as pafs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from flotilla.llm.shared import ascii_lower, attempt_name, filesystem, open_output, whole_row
from flotilla.session import cut_lineage, fresh_path

JUDGED = "host string, path string, rule string, verdict string"
#: Rules of a key range, about.
SHARD_RULES = 1 << 20


@dataclass(frozen=True)
class UrlIndex:
    files: tuple[tuple[int, str], ...]  # (shard, file); at most 2 ** bits
    bits: int                           # of a key that name its shard
    path_lengths: tuple[int, ...]       # distinct lengths of the rules' paths
    longest_host: int                   # characters of the rules' longest host


def digest(key: bytes) -> int:
    """Spark's xxhash64 of a string, unsigned."""
    return xxhash.xxh64_intdigest(key, seed=42)


def pack_shard(rules: list[tuple[bytes, bool]]) -> bytes:
    """One file: count, sorted keys, string offsets, block flags, strings."""
    rules = sorted((digest(k), k, block) for k, block in rules)
    blob = b"".join(k for _, k, _ in rules)
    ends = np.cumsum([0] + [len(k) for _, k, _ in rules], dtype=np.uint64)
    return b"".join([np.uint64(len(rules)).tobytes(), np.array([d for d, _, _ in rules], np.uint64).tobytes(),
                     ends.tobytes(), np.array([b for _, _, b in rules], np.uint8).tobytes(), blob])


class Shard:
    """A mapped file of :func:`pack_shard`."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view(np.uint64)[0])
        self.keys = raw[8:8 + 8 * n].view(np.uint64)
        self.ends = raw[8 + 8 * n:16 + 16 * n].view(np.uint64)
        self.block = raw[16 + 16 * n:16 + 17 * n]
        self.blob = raw[16 + 17 * n:]

    def find(self, digests: np.ndarray, keys: list[bytes]) -> np.ndarray:
        """Per probe: 1 block, 0 allow, -1 no such rule."""
        out = np.full(len(keys), -1, np.int8)
        at = np.searchsorted(self.keys, digests)
        inside = at < len(self.keys)
        hit = np.flatnonzero(inside & (self.keys[np.where(inside, at, 0)] == digests)) if len(self.keys) else []
        for i in hit:
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == digests[i]:  # equal digests lie side by side
                if self.blob[int(self.ends[j]):int(self.ends[j + 1])].tobytes() == keys[i]:
                    out[i] = self.block[j]
                    break
                j += 1
        return out


def build_index(rules: DataFrame) -> UrlIndex:
    """Index of ``rules`` (host, path, verdict 'allow' or 'block').

    Hosts are lower-cased (A-Z); a null host or path counts as empty. Of rules
    given twice with different verdicts, block holds.
    """
    spark = rules.sparkSession
    folder = fresh_path(spark, "url-index")
    host, path = F.coalesce(ascii_lower(F.col("host")), F.lit("")), F.coalesce("path", F.lit(""))
    keyed = (rules.select(F.concat(host, path).alias("key"), F.char_length(path).alias("n"), F.char_length(host).alias("h"), (F.col("verdict") == "block").alias("block"))
             .groupBy("key", "n", "h").agg(F.max("block").alias("block")))
    keyed = cut_lineage(keyed, "url-rules")
    n, longest = keyed.agg(F.count("*"), F.max("h")).first()
    bits = max(0, (-(-n // SHARD_RULES) - 1).bit_length())
    keyed = keyed.withColumn("shard", F.shiftrightunsigned(F.xxhash64("key"), 64 - bits).cast("int") if bits else F.lit(0))

    def write(shard_key, pdf: pd.DataFrame) -> pd.DataFrame:
        name = attempt_name(folder, f"digests-{shard_key[0]:02d}", ".bin")
        with open_output(name) as f:
            f.write(pack_shard([(k.encode(), bool(b)) for k, b in zip(pdf.key, pdf.block)]))
        return pd.DataFrame({"shard": [shard_key[0]], "file": [name]})

    written = cut_lineage(keyed.groupBy("shard").applyInPandas(write, "shard int, file string"), "url-index-files")
    files = [(r.shard, r.file) for r in written.collect()]  # a row per SHARD_RULES rules
    # Distinct lengths: no more than the longest path has characters.
    lengths = sorted(r.n for r in keyed.select("n").distinct().collect())
    if files and not isinstance(filesystem(files[0][1])[0], pafs.LocalFileSystem):
        for _, f in files:
            spark.sparkContext.addFile(f)
    return UrlIndex(tuple(files), bits, tuple(lengths), longest or 0)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    host = rest[:end].translate({c: c + 32 for c in range(65, 91)})
    return host, path[:stop]


def candidate_keys(host: str, path: str, lengths: tuple[int, ...], longest_host: int) -> Iterator[tuple[int, int, str]]:
    """(length, host length, key) of each rule that would fit."""
    suffix = host
    if len(host) > longest_host:  # the first suffix that a rule's host could be
        dot = host.find(".", len(host) - longest_host - 1)
        if dot < 0:
            return
        suffix = host[dot + 1:]
    while True:
        for n in lengths:
            if n > len(path):
                break
            yield len(suffix) + n, len(suffix), suffix + path[:n]
        dot = suffix.find(".")
        if dot < 0:
            return
        suffix = suffix[dot + 1:]


def _local(uri: str) -> str:
    fs, path = filesystem(uri)
    return path if isinstance(fs, pafs.LocalFileSystem) else SparkFiles.get(uri.rsplit("/", 1)[1])


def judge_batch(urls: list[str | None], shards: dict[int, Shard], index: UrlIndex):
    """(host, path, rule, verdict) lists for a batch."""
    parts = [split_url(u) for u in urls]
    owner, rank, keys = [], [], []
    for i, (host, path) in enumerate(parts):
        for n, h, key in candidate_keys(host, path, index.path_lengths, index.longest_host):
            owner.append(i)
            rank.append((n, h))
            keys.append(key)
    raw = [k.encode() for k in keys]
    digests = np.fromiter(map(digest, raw), np.uint64, len(raw))
    found = np.full(len(raw), -1, np.int8)
    home = digests >> np.uint64(64 - index.bits) if index.bits else np.zeros(len(raw), np.uint64)
    for s, shard in shards.items():
        mine = np.flatnonzero(home == s)
        found[mine] = shard.find(digests[mine], [raw[i] for i in mine])
    best: dict[int, tuple] = {}
    for j in np.flatnonzero(found >= 0):
        entry = (*rank[j], j)
        if owner[j] not in best or entry > best[owner[j]]:
            best[owner[j]] = entry
    rule = [keys[best[i][2]] if i in best else None for i in range(len(parts))]
    verdict = ["block" if i in best and found[best[i][2]] else "allow" for i in range(len(parts))]
    return [p[0] for p in parts], [p[1] for p in parts], rule, verdict


def url_filter(df: DataFrame, index: UrlIndex, url_col: str = "url") -> DataFrame:
    """``row`` (all input columns), ``host``, ``path``, ``rule`` and ``verdict``, a
    row per row.

    A rule fits its own host and all subdomains when the url's path starts
    with the rule's path; of the rules that fit, the longest wins (of equally
    long ones that with the longer host). Without a fitting rule the digest
    array holds no match: the verdict is allow and the rule null. Null urls and
    urls without ``://`` have an empty host and path.
    The work a url makes is bounded by the rules' lengths, not by its own; repeated rows
    are judged one by one, an empty table gives an empty result, and other columns,
    whatever their names, are carried in ``row``.
    """
    @F.pandas_udf(JUDGED)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shards = {s: Shard(_local(f)) for s, f in index.files}
        for urls in batches:
            values = [None if pd.isna(u) else u for u in urls]
            host, path, rule, verdict = judge_batch(values, shards, index)
            yield pd.DataFrame({"host": host, "path": path, "rule": pd.Series(rule, dtype=object), "verdict": verdict})

    return df.select(whole_row(df).alias("row"), judge(F.col(f"`{url_col}`")).alias("j")).select("row", "j.*")
