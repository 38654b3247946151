import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import langid

PIECES = {
    "en": ["the", "th", "ing", "er", "and", "ou", "wh"],
    "de": ["der", "sch", "ung", "ein", "ich", "ü", "cht"],
    "es": ["ción", "los", "que", "ado", "ñ", "ra", "ir"],
    "fr": ["eau", "oi", "ment", "è", "ou", "tre", "aux"],
    "xx": ["kkk", "zz", "qo", "vv", "jx", "wu", "yy"],
}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(PIECES[lang], k=rng.randint(1, 3))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, lang := rng.choice(list(PIECES)), rng.randint(3, 60)), lang) for i in range(900)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).cache()


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), rows=100)


def test_families_and_duels(model):
    assert model.families == (("germanic", ("de", "en")), ("romance", ("es", "fr")), ("xx", ("xx",)))
    assert model.classifiers == (("germanic", None), ("romance", None), ("xx", None), ("de", "en"), ("es", "fr"))


def test_held_out_accuracy(docs, model):
    rows = langid.with_language(docs, model).where(langid.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 200 and all(zlib.crc32(str(row.doc_id).encode()) % 3 == 1 for row in rows)
    assert sum(row.lang_pred == row.lang for row in rows) >= 0.98 * len(rows)
    assert all(0 <= row.score <= 1 for row in rows)


def test_fit_is_the_same_again(docs, model):
    again = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))).repartition(7), rows=100)
    assert again.classifiers == model.classifiers and (again.weights == model.weights).all()


def plain_profile(text):
    """Slices of the whole text, counted one by one."""
    gapped = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    while "  " in gapped:
        gapped = gapped.replace("  ", " ")
    return sum(len(gapped) - n + 1 for n in (1, 2, 3)) - gapped.count(" ")


def test_profile_reads_all_pieces(monkeypatch):
    letters = langid.letter_table()
    text = "Ab, c--d  éÉ\n12 xyz " * 9 + "end"
    whole = langid.profile(text, letters)
    assert np.isclose((whole**2).sum(), 1, atol=1e-5)
    shares = (whole.astype(float) ** 2)[whole > 0]
    n = plain_profile(text)
    assert np.allclose(shares * n, np.round(shares * n), atol=1e-2) and round((shares * n).sum()) == n
    for piece in (1, 2, 3, 7):
        monkeypatch.setattr(langid, "PIECE", piece)
        assert np.allclose(langid.profile(text, letters), whole, atol=1e-6)


def test_svm_separates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    y = np.where(x @ [1, -2, 0.5, 0, 1] + 0.3 > 0, 1.0, -1.0)
    weights = langid.svm(x, y)
    assert ((x @ weights[:-1] + weights[-1]) * y > 0).mean() > 0.97


def test_edges(spark, docs, model):
    long = prose(random.Random(1), "es", 200_000)
    rows = [(1, None), (2, ""), (3, "12 -- 7!"), (4, long), (None, "der schung einung ich"), (5, "the ing"), (5, "the ing"), (6, "Ⅷ²")]
    given = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, score int, lang_pred string")
    found = langid.with_language(given, model)
    assert found.columns == ["doc_id", "text", "lang_pred", "score"]
    by_id = {}
    for row in found.collect():
        by_id.setdefault(row.doc_id, []).append((row.lang_pred, row.score))
    assert by_id[1] == by_id[2] == by_id[3] == by_id[6] == [("und", 0.0)]
    assert by_id[4][0][0] == "es" and by_id[None][0][0] == "de" and len(by_id[5]) == 2 and len(set(by_id[5])) == 1
    assert langid.with_language(given.limit(0), model).collect() == []


def test_little_to_learn_from(spark, docs):
    none = langid.fit(docs.limit(0))
    some = docs.where("doc_id < 5").select("doc_id", "text")
    assert {(r.lang_pred, r.score) for r in langid.with_language(some, none).collect()} == {("und", 0.0)}
    wordless = spark.createDataFrame([(1, "12", "en"), (2, None, "en"), (3, "the ing", None)], "doc_id long, text string, lang string")
    assert langid.fit(wordless).families == ()
    one = langid.fit(docs.where("lang = 'en'"))
    assert {r.lang_pred for r in langid.with_language(some, one).collect()} == {"en"}
    two = langid.fit(docs.where("lang IN ('en', 'de')"))
    assert two.classifiers == (("de", "en"),)
    repeated = spark.createDataFrame([(1, "the ing", "en")] * 300 + [(2, "schung ich", "de")], "doc_id long, text string, lang string")
    rows = langid.with_language(repeated, langid.fit(repeated, rows=10)).collect()
    assert {(row.lang, row.lang_pred) for row in rows} == {("en", "en"), ("de", "de")}
