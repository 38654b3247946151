import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.operators import embedding, rerank


def test_hashed_embedding(spark):
    texts = ["a b b", "a b b", "A  c\nd", "", None]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, text string").fillna("", "text")
    found = {r.n: r.embedding for r in embedding.embed(rows, dim=32).collect()}

    def index(word):
        return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 32

    for n, text in enumerate(texts):
        counts = np.zeros(32)
        for word in ("query: " + (text or "")).lower().split():
            counts[index(word)] += 1
        assert found[n] == pytest.approx(list(counts / np.linalg.norm(counts)), abs=1e-6)
    assert found[0] == found[1]


def test_whole_texts_are_read(spark):
    words = " ".join(["w"] * 5000)
    rows = spark.createDataFrame([(words,)], "text string")
    terms = embedding.hashed_terms(rows, "text", dim=8, prefix=None).first().terms
    assert sum(terms.values) == 5000


def test_model_hook(spark):
    class Lengths:
        def encode(self, texts):
            assert len(texts) <= 3
            return np.array([[len(text), 1.0] for text in texts])

    rows = spark.createDataFrame([(n, "x" * n) for n in range(10)], "n int, text string").repartition(2)
    found = embedding.embed_with(rows, Lengths, batch_size=3).collect()
    assert {r.n: r.embedding for r in found} == {n: [n + len("query: "), 1.0] for n in range(10)}
    plain = embedding.embed_with(rows, Lengths, prefix=None, batch_size=3).collect()
    assert {r.n: r.embedding[0] for r in plain} == {n: float(n) for n in range(10)}


def test_token_limit(spark):
    rows = spark.createDataFrame([("a b  c\td e",), ("a",), ("",)], "text string")
    found = [sum(r.terms.values) for r in embedding.hashed_terms(rows, "text", dim=8, max_tokens=3).collect()]
    assert sorted(found) == [1, 2, 3]
    assert embedding.first_words(" a b  c ", 2) == " a b" and embedding.first_words(" a b  c ", 3) == " a b  c "

    class Words:
        def encode(self, texts):
            return [[float(len(text.split()))] for text in texts]

    class Tokens(Words):
        def truncate(self, text, n):
            return " ".join(text.split()[:n] + ["end"])

    for model, most in ((Words, 3), (Tokens, 4)):
        made = embedding.embed_with(rows, model, max_tokens=3).collect()
        assert {r.text: r.embedding[0] for r in made} == {"a b  c\td e": most, "a": 2 + most - 3, "": 1 + most - 3}


def test_packed_batches():
    lengths = [5, 1, 9, 2, 2, 30, 1]
    batches = list(embedding.packed(lengths, 3, 12))
    assert sorted(place for batch in batches for place in batch) == list(range(7))
    for batch in batches:
        assert len(batch) <= 3 and (len(batch) == 1 or max(lengths[p] for p in batch) * len(batch) <= 12)
    assert list(embedding.packed([], 3, 12)) == []


def training(spark):
    rng = random.Random(5)
    rows = []
    for n in range(120):
        label = int(n % 6 == 0)
        rows.append((f"W{n}", label, [rng.gauss(label, 1.0), rng.gauss(-label, 1.0), rng.gauss(0, 1)]))
    return spark.createDataFrame(rows, "id string, label_included int, embedding array<float>"), rows


def newton(rows, c=1.0):
    x = np.array([np.float32(r[2]) for r in rows], dtype=float)
    x = np.c_[x, np.ones(len(x))]
    y = np.array([r[1] for r in rows], dtype=float)
    share = {label: len(rows) / (2 * (y == label).sum()) for label in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    penalty = np.diag([1 / c] * 3 + [0])
    beta = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (weight * (p - y)) + penalty @ beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return beta


@pytest.mark.parametrize("parts", [1, 7])
def test_classifier_agrees_with_newton_steps(spark, parts):
    table, rows = training(spark)
    model = rerank.fit_classifier(table.repartition(parts), tol=1e-9)
    beta = newton(rows)
    assert list(model.coefficients) + [model.intercept] == pytest.approx(list(beta), abs=1e-4)
    scored = rerank.score(model, table.select("id", "embedding"))
    assert scored.columns == ["id", "embedding", "relevance_score"]
    best = rerank.top_scored(scored, 10).collect()
    expected = {r[0]: 1 / (1 + math.exp(-(np.dot(np.float32(r[2]), beta[:3]) + beta[3]))) for r in rows}
    assert [r.id for r in best] == sorted(expected, key=lambda i: -expected[i])[:10]
    assert best[0].relevance_score == pytest.approx(max(expected.values()), abs=1e-4)


def test_balanced_weights(spark):
    table, _ = training(spark)
    weights = {r.label_included: r.w for r in rerank.balance(table, rerank.class_sizes(table)).groupBy("label_included").agg(F.sum("weight").alias("w")).collect()}
    assert weights == {0: pytest.approx(60), 1: pytest.approx(60)}


def test_gradient_is_zero_at_the_fit_only(spark):
    table, _ = training(spark)
    assert rerank.largest_gradient(rerank.fit_classifier(table, tol=1e-9), table) < 1e-5
    assert rerank.largest_gradient(rerank.fit_classifier(table, max_iter=1), table) > 1e-3


def test_linear_scores(spark):
    table, rows = training(spark)
    x = np.array([np.float32(r[2]) for r in rows], dtype=float)
    y = np.array([r[1] for r in rows])
    direction = x[y == 1].mean(axis=0) - x[y == 0].mean(axis=0)
    found = {r.id: r.relevance_score for r in rerank.linear(table)(table).collect()}
    assert found == {r[0]: pytest.approx(float(v @ direction)) for r, v in zip(rows, x)}
