"""Language ID: its filter, its cases and its held-out accuracy."""

import numpy as np

from conftest import SF_MID
from flotilla.llm import langid
from flotilla.llm.queries import QUERIES

EN, DE = "the house and the garden with the tree", "der garten und das haus mit dem baum über"


def model_of(spark, rows, **kw):
    return langid.fit(spark.createDataFrame(rows, "lang string, text string"), **kw)


def test_every_ngram_of_a_language_is_answered(spark):
    """No false negatives: a text of training n-grams counts all of them."""
    model = model_of(spark, [("en", EN)] * 3 + [("de", DE)] * 2 + [(None, "xxx yyy"), ("en", None), ("fr", "")])
    assert model.languages == ("de", "en", "fr")
    keys, _, _ = langid.grams([EN.encode()])
    mask = np.full(len(keys), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in langid.slots_of(keys):
        mask &= model.slots[at]
    assert ((mask >> np.uint64(1)) & np.uint64(1)).all()
    assert (model.false < 0.01).all()


def test_cases(spark):
    model = model_of(spark, [("en", EN)] * 3 + [("de", DE)] * 2)
    texts = [EN, DE, EN.upper(), None, "", "123 !? 456", "ÜBER", "x", "日本語", "the " * 100_000, EN, EN]
    docs = spark.createDataFrame([(t, i, "l", 0.5) for i, t in enumerate(texts)], "text string, doc_id long, lang_pred string, score double").repartition(3)
    out = langid.predict(docs, model)
    assert out.select("row.*").columns == docs.columns
    got = {r.row.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert len(got) == len(texts) and [got[i][0] for i in (0, 1, 2, 6, 9, 10)] == ["en", "de", "en", "de", "en", "en"]
    assert all(got[i] == ("und", 0.0) for i in (3, 4, 5)) and got[8][0] == "de" and got[8][1] == 0  # letters, but no known n-gram: first in the alphabet
    assert all(0 <= s <= 1 for _, s in got.values())
    assert langid.predict(docs.limit(0), model).count() == 0


def test_nothing_learned(spark):
    model = model_of(spark, [(None, "abc")])
    docs = spark.createDataFrame([("abc",), (None,)], "text string")
    assert [(r.lang_pred, r.score) for r in langid.predict(docs, model).collect()] == [("und", 0.0)] * 2


def test_rare_ngrams_of_other_languages_are_left_out(spark):
    rows = [("en", EN)] * 99 + [("en", DE)] + [("de", DE)] * 10
    strict = model_of(spark, rows)
    keys = langid.grams([DE.encode()])[0]
    mask = strict.slots[langid.slots_of(keys)[0]]
    assert ((mask >> np.uint64(1)) & np.uint64(1)).mean() < 0.3


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    got = QUERIES["op6_language"](spark, SF_MID).collect()
    assert len(got) == len(lang) and {r.held_out for r in got} == {True, False}
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_more_languages_than_a_word_has_bits(spark):
    """Languages in other letters each, the first, the 64th, the 65th and the last among them."""
    names = [f"l{i:03}" for i in range(130)]
    text = {n: " ".join("".join(chr(0x4E00 + 40 * i + (7 * k + j) % 40) for j in range(6)) for k in range(6)) for i, n in enumerate(names)}
    model = model_of(spark, [(n, t) for n, t in text.items()] * 2)
    assert model.languages == tuple(names) and (model.false < 0.01).all()
    docs = spark.createDataFrame(list(text.items()), "want string, text string")
    got = langid.predict(docs, model).collect()
    assert len(got) == 130 and all(r.lang_pred == r.row.want and r.score > 0.9 for r in got)
