"""Pairs of lists with many common ids against all pairs."""

import itertools
import random

import pytest

from sieveline import settings
from sieveline.operators import responses


def brute(rows, least):
    lists = {}
    for id_, query_pos in rows:
        if id_ is not None and query_pos is not None:
            lists.setdefault(query_pos, set()).add(id_)
    pairs = ((a, b, len(lists[a] & lists[b])) for a, b in itertools.combinations(sorted(lists), 2))
    return {pair for pair in pairs if pair[2] >= least}


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, query_pos int").repartition(4)


@pytest.mark.parametrize("least", [1, 3, 8, 25])
@pytest.mark.parametrize("block", [1_000, 4])
def test_all_pairs(spark, monkeypatch, least, block):
    monkeypatch.setattr(settings, "LIST_BLOCK", block)
    drawn = random.Random(least)
    # Lists of different lengths over popular and rare ids, copies, one id in all lists, nulls and repeated rows.
    rows = [(f"W{int(drawn.paretovariate(0.7)) % 400}", n) for n in range(14) for _ in range(drawn.choice([2, 30, 60]))]
    rows += [(f"C{i}", n) for n in (20, 21, 22) for i in range(25)] + [("W1", n) for n in range(23)]
    rows += rows[:40] + [(None, 3), (None, 4), ("W1", None), (None, None)]
    found = responses.large_overlaps(table(spark, rows), least).collect()
    assert len(found) == len({tuple(row) for row in found})
    assert {tuple(row) for row in found} == brute(rows, least) != set()


def test_nothing_in_common(spark):
    assert responses.large_overlaps(table(spark, [("W1", 1), ("W2", 2), ("W1", 1)]), 1).collect() == []
    assert responses.large_overlaps(table(spark, []), 1).collect() == []
    with pytest.raises(ValueError):
        responses.large_overlaps(table(spark, []), 0)


def test_ids_of_all_lists_pair_none(spark, monkeypatch):
    """Lists that share a few ids with all others, as popular works, are not paired over them."""
    rows = [(f"P{i}", n) for n in range(60) for i in range(4)] + [(f"W{n}-{i}", n) for n in range(60) for i in range(6)]
    rows += [(f"W0-{i}", 99) for i in range(6)]
    paired = []
    real = responses._meetings

    def meetings(hits, block):
        met = real(hits, block)
        paired.append(met.where("query_a < query_b").count())
        return met

    monkeypatch.setattr(responses, "_meetings", meetings)
    assert {tuple(row) for row in responses.large_overlaps(table(spark, rows), 5).collect()} == {(0, 99, 6)}
    assert paired[0] <= 6
