import collections
import math
import random
import re

import pytest

from sieveline.llm import bitsliced

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    """Plain form: sorted [(item_id, rank, doc_id, score)] of [(doc_id, text)], [(item_id, text)]."""
    held = [(doc_id, collections.Counter(terms(text))) for doc_id, text in docs]
    held = [(doc_id, counted, sum(counted.values())) for doc_id, counted in held if counted]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = collections.Counter(term for _, counted, _ in held for term in counted)
    found = []
    for item_id, text in items:
        scores = []
        for doc_id, counted, n in held:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = 0
            for term in terms(text):
                if tf := counted[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scores)[:top], 1):
            found.append((item_id, rank, None if none else doc_id, -score))
    return sorted(found, key=str)


def prose(rng, n):
    words = ["Der", "île", "x1", "of", "the", "ПРИвет", "a"] + [f"w{i}" for i in range(80)]
    return "".join(rng.choices(words, [40] * 7 + [1] * 80)[0] + rng.choice([" ", " ", "_", "\n", "--", "\x7f"]) for _ in range(n))


def rows(found):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    docs = [(i, prose(rng, rng.choice([1, 5, 40, 40, 300]))) for i in range(500)]
    docs += [(1_000 + i, docs[7][1]) for i in range(40)]
    items = [(i, prose(rng, rng.choice([1, 6, 30]))) for i in range(25)] + [(99, docs[7][1])]
    return docs, items


@pytest.mark.parametrize("query_bytes", [1 << 20, 300])
def test_as_brute_force(spark, corpus, query_bytes):
    docs, items = corpus
    given = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = bitsliced.search(given, spark.createDataFrame(items, "item_id long, text string"), query_bytes=query_bytes)
    assert rows(found) == brute(docs, items)


def test_bounds_hold_and_exclude(spark, corpus):
    docs, items = corpus
    given = spark.createDataFrame(docs, "doc_id long, text string")
    blocks = bitsliced.index(given)
    sums = blocks.selectExpr("sum(n_docs)", "sum(n_terms)").first()
    query = bitsliced.Query([text.encode() for _, text in items], *sums)
    query.weigh(bitsliced.document_frequencies(given, query.terms))
    bounds = {(r.item, r.doc_id): r.bound for r in bitsliced.not_excluded(blocks, query, [1.0] * len(items)).collect()}
    exact, above = {}, 0
    for item in range(len(items)):
        for doc_id, text in docs:
            counted = collections.Counter(bitsliced.terms(text.encode()))
            exact[item, doc_id] = query.score(item, counted, query.normal(sum(counted.values())))
            assert exact[item, doc_id] <= bounds.get((item, doc_id), 0)
    for item in range(len(items)):
        tenth = sorted((exact[item, doc_id] for doc_id, _ in docs), reverse=True)[9]
        above += sum(bounds.get((item, doc_id), 0) >= max(tenth, 1) for doc_id, _ in docs)
    assert above < 0.35 * len(exact)


def test_edges(spark):
    long = "common " * 200_000 + " ".join(f"t{i}" for i in range(30_000))
    docs = [(1, None), (2, ""), (3, "--- !!"), (4, long), (5, "rare Common"), (5, "other common"), (None, "rare common")]
    docs += [(None, "rare common")] + [(10 + i, "tie tie rare") for i in range(30)] * 2
    items = [(1, "RARE common"), (2, None), (3, ""), (4, "nowhere"), (5, "tie"), (5, "rare"), (6, long), (None, "t7 t9"), (1, "RARE common")]
    given = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, rank int, item_id string")
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, score int")
    assert rows(bitsliced.search(given, asked)) == brute(docs, list(dict.fromkeys(items)))
    nothing = given.limit(0)
    assert bitsliced.search(nothing, asked).collect() == []
    assert bitsliced.search(given, asked.limit(0)).collect() == []
    assert bitsliced.search(given.where("doc_id < 4"), asked).collect() == []
