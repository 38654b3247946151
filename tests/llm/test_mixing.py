import collections
import random

import pytest
from brute import targets, words
from pyspark.sql import functions as F

from sieveline.llm import mixing


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def corpus(seed, sources):
    rng = random.Random(seed)
    rows, i = [], 0
    for name, n in sources.items():
        for _ in range(n):
            rows.append((i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(0, 60))), name))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sources", [{"a": 400, "b": 30, "c": 90, None: 50, "d": 5}, {"one": 30}, {"a": 1, "b": 500}])
def test_targets_and_taken(spark, sources):
    rows = corpus(3, sources)
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    wanted = targets(sizes)
    found = mixing.fair_mix(frame(spark, rows).repartition(5)).collect()
    assert len(found) == len(rows)
    taken, largest = collections.Counter(), 0
    for row in found:
        text = next(text for i, text, _ in rows if i == row.doc_id)
        assert row.size == len(words(text)) and row.source_size == sizes[row.source]
        assert row.target == pytest.approx(wanted[row.source])
        assert row.taken == row.copies * row.size and 0 <= row.copies <= 3
        taken[row.source] += row.taken
        largest = max(largest, row.size)
    for source in sources:
        assert abs(taken[source] - wanted[source]) <= 2 * largest
    assert 0 <= sum(taken.values()) - sum(sizes.values()) < largest


def test_reruns_and_partitions_agree(spark):
    docs = frame(spark, corpus(4, {"a": 100, "b": 40}))
    answers = [sorted(map(tuple, mixing.fair_mix(docs.repartition(n)).select("doc_id", "taken").collect())) for n in (1, 9, 9)]
    assert answers[0] == answers[1] == answers[2]
    other = sorted(map(tuple, mixing.fair_mix(docs, seed=1).select("doc_id", "taken").collect()))
    assert other != answers[0]


def test_edges(spark):
    rows = [(1, None, "a"), (None, "x y", None), (None, "x y", None), (3, "x", "b"), (3, "x", "b"), (4, "", "c"), (5, "one two three " * 4000, "a")]
    found = mixing.fair_mix(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    assert all(row.taken == 0 for row in found if row.size == 0)
    assert len({(row.copies, row.target) for row in found if row.doc_id == 3}) == 1
    assert mixing.fair_mix(frame(spark, [])).count() == 0
    assert all(row.taken == 0 for row in mixing.fair_mix(frame(spark, [(1, None, "a"), (2, " ", "b")])).collect())


def test_mixed_rows(spark):
    docs = frame(spark, corpus(6, {"a": 60, "b": 200, "c": 90}))
    docs = docs.withColumns({name: F.lit(name) for name in ("size", "row", "copies", "_row", "key", "total")})
    copies = {row.doc_id: row.copies for row in mixing.fair_mix(docs).collect()}
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert collections.Counter(row.doc_id for row in mixed.collect()) == collections.Counter({i: n for i, n in copies.items() if n})
