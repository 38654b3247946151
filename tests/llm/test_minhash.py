import random

import pytest
from brute import near_groups
from pyspark.sql import functions as F

from sieveline.llm import minhash
from sieveline.llm.components import components
from sieveline.staging import stage


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def found(docs):
    return {row.doc_id: (row.n_shingles, row.component_id) for row in minhash.near_duplicates(docs).collect()}


def variants(rng, n, length, edits):
    """A text and copies in which a few words differ."""
    base = [f"w{rng.randint(0, 5000)}" for _ in range(length)]
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(length)] = f"x{rng.randint(0, 10**6)}"
        yield " ".join(own)


def test_against_all_pairs(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(25):
        texts += variants(rng, rng.randint(1, 9), rng.choice([6, 30, 80, 200]), 6)
    # A large group of copies and near copies, and a passage that many share.
    texts += list(variants(rng, 150, 60, 4)) + ["same words in all of them here"] * 60
    passage = " ".join(f"p{n}" for n in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(rng.choice([5, 12, 40]))) for _ in range(80)]
    texts += ["Two Words", "two\twords", "two  words \n", "one", "", " \n ", "five words are one shingle"]
    rng.shuffle(texts)
    docs = dict(enumerate(texts))
    assert found(frame(spark, list(docs.items())).repartition(6)) == near_groups(docs)


def test_chains_go_through_links(spark):
    words = [f"w{n}" for n in range(400)]
    docs = {n: " ".join(words[n * 10 : n * 10 + 200]) for n in range(15)}
    groups = near_groups(docs)
    assert {component for _, component in groups.values()} == {0}
    assert found(frame(spark, list(docs.items()))) == groups


def test_edges(spark):
    long = " ".join(f"w{n % 977}x{n % 613}" for n in range(60_000))
    rows = [(None, "a text of a few words"), (None, "a text of a few words"), (2, "a text of a few words"), (1, None), (4, ""), (5, long), (6, long + " end"), (9, "a text of a few words")]
    result = sorted(map(tuple, minhash.near_duplicates(frame(spark, rows)).select("doc_id", "component_id", "kept").collect()), key=repr)
    assert result == sorted([(None, None, True), (None, None, True), (2, 2, True), (1, 1, True), (4, 4, True), (5, 5, True), (6, 5, False), (9, 2, False)], key=repr)
    assert found(frame(spark, [])) == {}


def test_rows_of_one_id_are_one_document(spark):
    one, other = "a text of some few words here", "quite another text of some more words here"
    rows = [(7, one), (7, other), (3, one), (5, other), (5, other)]
    assert {row.component_id for row in minhash.near_duplicates(frame(spark, rows)).collect()} == {3}


def test_dedup_keeps_columns(spark):
    docs = frame(spark, [(2, "all of the same words"), (1, "All of the same words"), (3, "something else")])
    docs = docs.withColumns({name: F.lit(name) for name in ("n", "digest", "keys", "kept", "component", "_doc", "_id")})
    kept = minhash.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(row.doc_id for row in kept.collect()) == [1, 3]


def test_buckets_of_many_components_are_compared_in_cells(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    texts = dict(enumerate(variants(random.Random(2), 90, 60, 3)))
    docs = frame(spark, list(texts.items()))
    signed = stage(minhash.signatures(docs), "signed")
    members = signed.select(F.explode("keys").alias("key"), "doc_id", F.col("doc_id").alias("component"))
    links = minhash._cell_links(members, minhash._mixed(members), signed, docs, 5, 75)
    groups = dict(map(tuple, components(links).collect()))
    assert {i: groups.get(i, i) for i in texts} == {i: component for i, (_, component) in near_groups(texts).items()}


@pytest.mark.parametrize("task_links", [10**6, 100])
@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape, task_links):
    rng = random.Random(1)
    if shape == "chain":
        nodes = rng.sample(range(1000), 300)
        links = list(zip(nodes, nodes[1:]))
    elif shape == "star":
        links = [(500, n) for n in range(300)]
    else:
        links = [(rng.randrange(600), rng.randrange(600)) for _ in range(350)]
    up = {n: n for link in links for n in link}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    linked = {n for a, b in links if a != b for n in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long").repartition(4), task_links).collect()
    assert sorted(map(tuple, got)) == sorted((n, find(n)) for n in linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
