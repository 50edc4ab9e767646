"""The url filter against a scan of the rules."""

import random

from hypothesis import given, settings, strategies as st

from flotilla.llm import urls


def plain(url, rules):
    host, path = urls.split_url(url)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[2] if best else None, best[3] if best else "allow"


def test_split_url():
    assert urls.split_url(None) == ("", "") and urls.split_url("no scheme/x") == ("", "")
    assert urls.split_url("http://A.Éx.COM") == ("a.Éx.com", "")
    assert urls.split_url("http://a.b?q=/x") == ("a.b", "") and urls.split_url("http://a.b#f/x") == ("a.b", "")
    assert urls.split_url("s://u@h:8/p/q?x://y#z") == ("u@h:8", "/p/q") and urls.split_url("a://b://c/d") == ("b:", "//c/d")


def test_against_a_scan(spark):
    rng = random.Random(5)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "aa.com", "", "co"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/é/", "/fr/"]
    rules = list({(rng.choice(hosts), rng.choice(paths)): None for _ in range(25)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    tests = [None, "", "nothing", "http://", "http://com", "http://COM/", "x://com/en/?a", "http://com." + "a" * 5000 + "/" + "b" * 5000]
    tests += [f"http://{rng.choice(['', 'www.', 'WWW.b.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'more', '?q', '#f'])}" for _ in range(300)]
    index = urls.build_index(spark.createDataFrame(rules, "host string, path string, verdict string"))
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(tests)], "page_id int, url string, host string, rule string")
    got = {r.row.page_id: tuple(r)[1:] for r in urls.url_filter(df, index).collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(tests)}


def test_conflicts_nulls_and_no_rules(spark):
    rules = spark.createDataFrame([("A.com", "/", "allow"), ("a.com", "/", "block"), (None, None, "block"), ("a.com", "/", "block")], "host string, path string, verdict string")
    index = urls.build_index(rules)
    df = spark.createDataFrame([("http://x.a.com/",), ("junk",), (None,)], "url string")
    assert [tuple(r)[3:] for r in urls.url_filter(df, index).collect()] == [("a.com/", "block"), ("", "block"), ("", "block")]
    empty = urls.build_index(rules.limit(0))
    assert [r.verdict for r in urls.url_filter(df, empty).collect()] == ["allow"] * 3
    assert urls.url_filter(df.limit(0), index).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.binary(min_size=1, max_size=6), st.booleans()), unique_by=lambda x: x[0], max_size=40))
def test_collisions_are_confirmed(tmp_path_factory, rules):
    """With a digest that collides all the time the full strings still decide."""
    real, urls.digest = urls.digest, lambda key: len(key) % 2
    try:
        path = tmp_path_factory.mktemp("shard") / "s.bin"
        path.write_bytes(urls.pack_shard(rules))
        import numpy as np
        keys = [k for k, _ in rules] + [b"absent!", b""]
        got = urls.Shard(str(path)).find(np.array([urls.digest(k) for k in keys], np.uint64), keys)
        assert got.tolist() == [int(b) for _, b in rules] + [-1, -1]
    finally:
        urls.digest = real


def test_very_long_hosts_and_paths(spark):
    """A host and a path of 1 MB make no more candidates than the rules are long."""
    rules = [("com", "/", "allow"), ("b.example.com", "/en/", "block"), ("example.com", "/" + "x" * 50, "block")]
    index = urls.build_index(spark.createDataFrame(rules, "host string, path string, verdict string"))
    host, path = "a." * 500_000 + "b.example.com", "/en/" + "x/" * 500_000
    tests = [f"http://{host}{path}", "http://" + "a." * 500_000 + path, "http://" + "a" * 1_000_000 + ".com" + path, f"http://{host}/{'x' * 1_000_000}"]
    assert all(len(list(urls.candidate_keys(*urls.split_url(t), index.path_lengths, index.longest_host))) <= 30 for t in tests)
    df = spark.createDataFrame([(t,) for t in tests * 3], "url string").coalesce(1)
    got = [(r.rule, r.verdict) for r in urls.url_filter(df, index).collect()]
    assert sorted(set(map(str, got))) == sorted({str((plain(t, rules)[2:])) for t in tests}) and len(got) == 12


def test_many_groups_of_rules(spark, monkeypatch):
    monkeypatch.setattr(urls, "SHARD_RULES", 10)
    rules = spark.range(300).selectExpr("concat('h', id, '.net') AS host", "'/' AS path", "if(id % 2 = 0, 'block', 'allow') AS verdict")
    index = urls.build_index(rules)
    assert index.bits == 5 and 16 <= len(index.files) <= 32
    df = spark.range(310).selectExpr("concat('http://w.h', id, '.net/x') AS url", "id")
    assert all(r.verdict == ("block" if r.row.id < 300 and r.row.id % 2 == 0 else "allow") and (r.rule is None) == (r.row.id >= 300) for r in urls.url_filter(df, index).collect())


def test_digest_is_sparks(spark):
    keys = ["", "a", "example.com/en/", "é日本", "x" * 100]
    got = [r[0] % 2 ** 64 for r in spark.createDataFrame([(k,) for k in keys], "k string").selectExpr("xxhash64(k)").collect()]
    assert got == [urls.digest(k.encode()) for k in keys]
