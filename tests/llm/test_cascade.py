import random

import pytest
from brute import measures
from pyspark.sql import functions as F

from sieveline.llm import cascade

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def counted(docs, rules=cascade.RULES):
    judged = cascade.cascade(docs, list(rules), complete=NAMES)
    return judged.select("doc_id", "kept", "failed_rule", "measured", "counts.*").collect()


TEXTS = [
    None, "", " \n\t", "one", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "a " * 500, "x\nx\n\n\nx\n x", "# $ %% | < >\x0b&",
    "é ü ß   w", "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 0", " ".join(map(str, range(9000))) + " " + " ".join(map(str, range(50))),
]


def test_measures(spark):
    rng = random.Random(8)
    texts = TEXTS + ["\n".join(" ".join(rng.choices("abc#|", k=rng.randint(0, 12))) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    for row in counted(frame(spark, texts)):
        assert tuple(row[name] for name in NAMES) == measures(texts[row.doc_id])


def test_kept_does_not_depend_on_the_order(spark):
    docs = frame(spark, TEXTS + ["GOOD WORDS " * 30, " ".join(f"word{n}" for n in range(40))])
    answers = []
    for seed in range(3):
        rules = list(cascade.RULES)
        random.Random(seed).shuffle(rules)
        answers.append({row.doc_id: row.kept for row in counted(docs, rules)})
    assert answers[0] == answers[1] == answers[2]
    assert answers[0][len(TEXTS) + 1] and not answers[0][len(TEXTS)]


def test_later_rules_are_not_tried(spark):
    rules = [rule for name in ("few_words", "repeats") for rule in cascade.RULES if rule.name == name]
    rows = {row.doc_id: row for row in counted(frame(spark, ["too few words", "a " * 500, " ".join(f"w{n}" for n in range(60))]), rules)}
    assert (rows[0].failed_rule, rows[0].measured.n_repeat_words) == ("few_words", None)
    assert (rows[1].failed_rule, rows[1].measured.n_repeat_words) == ("repeats", 500)
    assert (rows[2].failed_rule, rows[2].measured.n_repeat_words) == (None, 0)


def test_estimates_and_order(spark):
    texts = ["short"] * 60 + [" ".join(f"w{n}{i}" for n in range(60)) for i in range(40)]
    estimates = {rule.name: (seconds, share) for rule, seconds, share in cascade.estimate(frame(spark, texts), rows=1000)}
    assert estimates["few_words"][1] == pytest.approx(0.6) and estimates["shouting"][1] == 0
    assert all(seconds > 0 for seconds, _ in estimates.values())
    made = [(cascade.RULES[0], 1.0, 0.2), (cascade.RULES[1], 4.0, 0.9), (cascade.RULES[2], 0.1, 0.0), (cascade.RULES[3], 0.5, 0.2)]
    assert [rule.name for rule in cascade.ordered(made)] == [cascade.RULES[n].name for n in (3, 1, 0, 2)]


def test_edges(spark):
    docs = frame(spark, ["a b", "a b"]).withColumns({name: F.lit(name) for name in ("kept", "_text", "_words", "_failed", "words", "n_words")})
    judged = cascade.apply_rules(docs)
    assert set(docs.columns) <= set(judged.columns)
    assert [(row._text, row.n_words, row.kept) for row in judged.collect()] == [("_text", "n_words", False)] * 2
    empty = frame(spark, ["x"]).limit(0)
    assert cascade.apply_rules(empty).count() == 0
