import random

import pytest
from brute import kept_lines
from pyspark.sql import functions as F

from sieveline.llm import lines

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts):
    return spark.createDataFrame([(i, text, "en", "s", 0) for i, text in texts], SCHEMA)


def judged(docs, **options):
    done = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs, **options))
    return {row.doc_id: (row.n_lines, row.n_dropped, row.kept_text) for row in done.collect()}


def test_against_brute_force(spark):
    rng = random.Random(5)
    pool = [f"line number {n} of the pool" for n in range(40)] + ["ÀÉ line of letters", "àé line of letters", "short"]
    texts = {}
    for i in rng.sample(range(-50, 400), 120):
        chosen = [rng.choice(pool) for _ in range(rng.randint(0, 90))]
        texts[i] = "\n".join(rng.choice(["", " ", "\t"]) + rng.choice([line, line.upper(), line]) for line in chosen)
    assert judged(frame(spark, texts.items()).repartition(7)) == kept_lines(texts)


def test_a_line_of_most_documents(spark):
    texts = {i: f"the same line everywhere\nown line of document {i}" for i in range(300)}
    assert judged(frame(spark, texts.items())) == kept_lines(texts)


def test_edges(spark):
    long = "\n".join(f"line {n} of a very long text" for n in range(5000))
    texts = {1: None, 2: "", 3: "exactly 10\nnine char", 4: "EXACTLY 10 \nnine char", 5: long, 6: long + "\n", 7: "\n\n"}
    assert judged(frame(spark, texts.items())) == kept_lines(texts)
    assert judged(frame(spark, [])) == {}


def test_null_and_repeated_ids(spark):
    rows = [(None, "a line that is here twice"), (None, "a line that is here twice"), (3, "a line that is here twice")]
    rows += [(5, "a line that is here twice\nx"), (5, "y\nother\na line that is here twice"), (3, "a line that is here twice")]
    docs = frame(spark, rows)
    done = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    found = sorted((row.doc_id is None, row.doc_id or 0, row.n_dropped, row.kept_text) for row in done.collect())
    kept = "a line that is here twice"
    assert found == [(False, 3, 0, kept), (False, 3, 0, kept), (False, 5, 1, "x"), (False, 5, 1, "y\nother"), (True, 0, 0, kept), (True, 0, 0, kept)]


def test_columns_with_clashing_names(spark):
    docs = frame(spark, [(1, "the first of two lines"), (2, "the first of two lines")])
    docs = docs.withColumns({name: F.lit(name) for name in ("pos", "line", "h1", "words", "row", "_id", "n_lines", "kept_text", "_doc")})
    done = lines.dedup_lines(docs)
    assert done.columns == docs.columns
    assert {row.doc_id: (row.text, row.n_lines, row._id) for row in done.collect()} == {
        1: ("the first of two lines", "n_lines", "_id"), 2: ("", "n_lines", "_id")
    }


def test_bitmaps_are_sparse_and_sorted(spark):
    text = "\n".join(["a line of them all"] + [f"line {n:03d} alone" for n in range(200)] + ["a line of them all"])
    docs = frame(spark, [(1, "a line of them all"), (2, text)])
    (row,) = lines.keep_bitmaps(docs).collect()
    assert row.doc_id == 2
    assert [(word.word, word.keep) for word in row.words] == [(0, ~1), (3, ~(1 << (201 - 192)))]


@pytest.mark.parametrize("least", [1, 30])
def test_least_length(spark, least):
    texts = {1: "a\nb\nthirty characters and some more of it", 2: "a\n c\nthirty characters and some more of it"}
    assert judged(frame(spark, texts.items()), least=least) == kept_lines(texts, least)
