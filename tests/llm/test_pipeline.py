"""The pipeline: every stage against brute force on its own input."""

import random

import corpus_pipeline as P
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_decontaminate import terms
from test_jaccard import brute as brute_groups
from test_linededup import brute as brute_lines

from flotilla.llm import packing
from flotilla.llm.queries import ORACLES, QUERIES
from flotilla.session import cut_lineage
from oracle import compare, duck


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_on_the_fixture(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = [docs]
    for _, stage in P.STAGES[:-1]:
        kept.append(cut_lineage(stage(spark, kept[-1], SF_SMALL)))
        assert kept[-1].columns == docs.columns and kept[-1].dtypes == docs.dtypes
    start, spoken, lines, single, clean = map(rows_of, kept)
    assert {i for i, r in start.items() if any(c.isalpha() for c in r.text or "")} == set(spoken)  # clean documents stay
    want = {i: t for i, t, _, _ in brute_lines([(i, r.text) for i, r in spoken.items()], P.MIN_LINE_DOCUMENTS)}
    assert {i: r.text for i, r in lines.items()} == want
    assert all(r.n_chars == len(r.text) for r in lines.values())
    groups = brute_groups([(i, r.text) for i, r in lines.items()])
    assert set(single) == {i for i, (_, c) in groups.items() if c == i} and len(single) < len(lines)
    items = [terms(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    grams = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in items]

    def leaks(text):
        w = terms(text)
        own = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        return max(len(g & own) / len(g) for g in grams)
    shares = {i: leaks(r.text) for i, r in single.items()}
    assert not [i for i in clean if shares[i] >= 0.95] and {i for i, s in shares.items() if s < 0.35} <= set(clean) and len(clean) < len(single)
    out = P.STAGES[-1][1](spark, kept[-1], SF_SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in out} == {i: len(r.text.encode().split()) for i, r in clean.items()} and len(out) == len(clean)
    whole = {tuple(r) for r in P.run(spark, SF_SMALL).collect()}
    assert whole == {tuple(r) for r in out}


def test_nulls_repeats_extra_columns_and_empty_table(spark):
    text = "the of and in this is that with for on at by " * 3
    rows = [(1, text, "en", "row"), (2, text, None, "x"), (2, text, None, "x"), (3, None, "en", None), (4, "123", "en", None), (None, text, "en", None), (5, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, row string")
    out = docs
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, out, SF_SMALL)
        assert out.columns == docs.columns
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [1, None]  # 3, 4, 5 have no letter, 2 copies 1
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF_SMALL)
    assert empty.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    ok, message = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert ok, message


def test_documents_with_a_letter_stay_at_a_larger_size(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    want = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in P.language_id(spark, docs, "").select("doc_id").collect()} == want


def test_language_stage_rejects_on_evidence_only(spark):
    rng = random.Random(3)
    en = ["the house and the garden with the tree " * 3] * 60
    zh = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(40)) for _ in range(60)]  # hardly a trigram twice
    odd = ["Ok", "A.", "q" * 30, "zxv " * 200]  # only the last is long enough to tell
    rows = [(i, t, "en" if t in en else "zh" if t in zh else None) for i, t in enumerate(en + zh + odd)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert P.language_id(spark, docs, "").count() == len(rows)  # nothing known of zh: any text may be it
    docs = docs.filter("lang IS NULL OR lang = 'en'")
    assert {r.text for r in P.language_id(spark, docs, "").collect()} == {*en, *odd[:-1]}
    unlearned = docs.withColumn("lang", F.lit(None).cast("string"))
    assert P.language_id(spark, unlearned, "").count() == len(en) + len(odd)


def test_one_row_of_each_group_stays(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, a, "x"), (5, a, "x"), (5, "all of its own", "x"),             # 5: a copy, and an unrelated row
            (7, b, "x"), (7, b, "x"), (7, b, "y"), (7, b + " more", "x"), (8, b, "x"),  # repeated under the group's smallest id
            (9, c, "x"), (9, "another " * 3, "x"), (10, c, "x"), (11, "another " * 3, "x"),  # two groups with the smallest id 9
            (None, a, "x"), (None, a, "x"), (12, "", "x"), (12, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, t1 string").repartition(3)
    out = P.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    sevens = [g for g in got if g[0] == 7]
    assert len(sevens) == 1 and sevens[0][1] in (b, b + " more")
    assert [g for g in got if g[0] != 7] == sorted([(3, a), (5, "all of its own"), (9, c), (9, "another " * 3), (None, a), (None, a), (12, ""), (12, None)], key=repr)
