"""Operators give one answer however their input is partitioned."""

import random

import pytest
from pyspark.sql import functions as F

from sieveline.operators import candidates, citations, feed, recall, responses


@pytest.fixture(scope="module")
def hits(spark):
    rng = random.Random(11)
    rows = []
    for query in range(6):
        for rank, n in enumerate(rng.sample(range(120), 60)):
            rows.append((query, f"q{query}", rank, f"W{n}"))
    return spark.createDataFrame(rows, "query_pos long, query_id string, rank int, id string").cache()


@pytest.fixture(scope="module")
def edges(spark):
    rng = random.Random(12)
    rows = [(f"W{rng.randint(0, 400)}", "W0" if n % 3 == 0 else f"W{rng.randint(0, 400)}") for n in range(3000)]
    return spark.createDataFrame(rows, "citing string, cited string").cache()


OPERATORS = {
    "keep_first": candidates.keep_first,
    "frequency": responses.frequency,
    "histogram": responses.frequency_histogram,
    "curve": lambda hits: responses.discovery_curve(hits, 60),
    "overlap": lambda hits: responses.overlap(hits, hits),
    "cutoff": lambda hits: responses.choose_cutoff(hits, 80, 60),
    "rank_lists": recall.rank_lists,
    "best_rank": recall.best_rank,
    "recall_curve": lambda hits: recall.recall_curve(hits, hits.select("id").limit(1), 60).drop("n_found", "recall"),
    "keep_latest": lambda hits: feed.keep_latest(
        hits.select("id", F.col("query_pos").alias("updated_date"), F.col("rank").alias("part"))
    ),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_hits(hits, name):
    answers = [sorted(map(repr, OPERATORS[name](hits.repartition(n)).collect())) for n in (1, 13)]
    assert answers[0] == answers[1] and answers[0]


@pytest.mark.parametrize("rows", [500, 0])
def test_snowball(spark, edges, rows):
    seeds = spark.createDataFrame([("W0",), ("W5",)], "id string")
    review = spark.createDataFrame([("W0",), ("W5",), ("W9",)], "id string")
    answers = [
        {r.id: r.level for r in citations.snowball(edges.repartition(n), seeds, review, rows).collect()} for n in (1, 13)
    ]
    assert answers[0] == answers[1]
    levels = set(answers[0].values())
    assert levels == {"primary", "secondary"} and not set(answers[0]) & {"W0", "W5", "W9"}


def test_curve_properties(hits):
    curve = responses.discovery_curve(hits, 60).orderBy("rank").collect()
    counts = [r.n_ids for r in curve]
    assert counts == sorted(counts) and counts[-1] == responses.distinct_ids(hits).first().n_ids
    matrix = {(r.query_a, r.query_b): r.n_common for r in responses.overlap(hits, hits).collect()}
    assert all(matrix[a, b] == matrix[b, a] for a, b in matrix) and {matrix[q, q] for q in range(6)} == {60}
