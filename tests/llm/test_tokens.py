"""Simple-8b and the token files."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from flotilla.llm import simple8b, tokens_out
from flotilla.llm.queries import byte_bpe


def round_trip(values):
    v = np.array(values, np.uint64)
    words, first, odd, first_odd = simple8b.encode(v)
    assert (simple8b.decode(words, first, odd, first_odd, len(v)) == v).all()
    return words, odd


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_256), st.integers(0, (1 << 64) - 1)), max_size=2500))
def test_round_trip_of_any_integers(values):
    round_trip(values)


def test_block_bounds_and_density():
    for n in (0, 1, simple8b.BLOCK - 1, simple8b.BLOCK, simple8b.BLOCK + 1, 3 * simple8b.BLOCK):
        round_trip(np.arange(n) % 7)
    words, _ = round_trip([1] * 600)
    assert len(words) == 10  # 60 ones a word
    words, odd = round_trip([1 << 63, 5, (1 << 60) - 1])
    assert len(odd) == 1


def test_blocks_are_found_by_their_offsets():
    v = np.random.default_rng(0).integers(0, 1 << 20, 5000).astype(np.uint64)
    words, first, odd, first_odd = simple8b.encode(v)
    end = int(first[3])
    one = simple8b.decode(words[int(first[2]):end], np.zeros(1, np.uint64), odd, np.zeros(1, np.uint64), simple8b.BLOCK)
    assert (one == v[2 * simple8b.BLOCK:3 * simple8b.BLOCK]).all()


TEXTS = st.text(st.one_of(st.sampled_from(" \n\t.,'!\u00a0\u2003aAbétT1"), st.characters(codec="utf-8")), max_size=40)


@pytest.fixture(scope="module")
def encoder():
    return tokens_out.Encoder(byte_bpe())


@pytest.fixture(scope="module")
def plain():
    """The library's plain call, on a tokenizer of its own."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(byte_bpe())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_give_the_ids_of_the_whole(encoder, plain):
    @settings(max_examples=300, deadline=None)
    @given(st.lists(TEXTS, max_size=6))
    def check(texts):
        texts = texts + ["the cat", "x <|endoftext|> y", "a<|endoftext|>", "<|endoftext |> it's", " x  y ", "a \u00a0 b\u3000 c\x1f d\x0b e\x85 f", "word\n", "\nword\nthe.\n1\n'll\n", "a\n\nb\n c", "x\x01y\nz", " n", ""]
        ids, n = encoder.encode(texts)
        want = [plain(t) for t in texts]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    check()
    assert plain("x <|endoftext|> y") == [87, 220, 50256, 331]


def test_forgetting_changes_nothing(plain, monkeypatch):
    monkeypatch.setattr(tokens_out, "CACHE_PIECES", 20)
    own = tokens_out.Encoder(byte_bpe())
    for k in range(30):
        texts = [f"word{k} and the {'x' * k} again, word{k - 1}.", f"the{k}"]
        ids, _ = own.encode(texts)
        assert ids.tolist() == [i for t in texts for i in plain(t)]


def test_files_round_trip(spark, plain):
    rows = [(i * 3 % 50, f"text number {i} " * (i % 7)) for i in range(50)] + [(None, "no id"), (None, None), (7, "again"), (1000, "long word " * 30_000), (1001, "x <|endoftext|> y")]
    df = spark.createDataFrame([(t, i, 1) for i, t in rows], "text string, doc_id long, base int").repartition(4)
    got = tokens_out.read_tokens(tokens_out.write_tokens(df, byte_bpe()), with_ids=True).orderBy("start").collect()
    assert len(got) == len(rows) and [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    want = sorted((i if i is not None else -1, plain(t or "") + [0]) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in got) == want
    assert tokens_out.read_tokens(tokens_out.write_tokens(df.limit(0), byte_bpe())).count() == 0


def test_equal_rows_spread(spark):
    """Rows equal in id and text are dealt to several files."""
    df = spark.range(8000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'' AS text").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else the few bytes go to one task
    try:
        manifest = tokens_out.write_tokens(df, byte_bpe())
        sizes = [r.n_docs for r in manifest.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 8000 and max(sizes) < 6000
    assert tokens_out.read_tokens(manifest).agg({"start": "max"}).first()[0] == 7999
