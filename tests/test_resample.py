import collections
import hashlib

import pytest

from sieveline.operators import resample


def hashed(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


ROWS = [(f"W{n}", n % 7 == 0 and 1 or 0, n) for n in range(3_000)]


def order(label, seed):
    return sorted((key for key, of, _ in ROWS if of == label), key=lambda key: (hashed(f"{seed}:{key}"), key))


@pytest.fixture(scope="module")
def table(spark):
    rows = ROWS + [(None, 1, 5), ("W1", None, 6)]
    return spark.createDataFrame(rows, "id string, label int, x int").cache()


@pytest.mark.parametrize("parts", [1, 9])
def test_without_replacement(spark, table, parts):
    for zero, one in ((1_000, 30), (1, 0), (9_999, 428)):
        sizes = spark.createDataFrame([(0, zero), (1, one), (7, 5)], "label int, n long")
        found = resample.without_replacement(table.repartition(parts), sizes, "id", "label", 3)
        assert found.columns == ["label", "id", "x"] or set(found.columns) == {"id", "label", "x"}
        found = collections.Counter((r.id, r.label) for r in found.collect())
        assert found == collections.Counter([(key, 0) for key in order(0, 3)[:zero]] + [(key, 1) for key in order(1, 3)[:one]])


@pytest.mark.parametrize("parts", [1, 9])
def test_with_replacement(spark, table, parts):
    sizes = spark.createDataFrame([(0, 100), (1, 5_000), (7, 5)], "label int, n long")
    found = resample.with_replacement(table.repartition(parts), sizes, "id", "label", 3).collect()
    expected = collections.Counter()
    for label, n in ((0, 100), (1, 5_000)):
        keys = order(label, 3)
        expected.update((keys[hashed(f"3:{label}:{j}") % len(keys)], label) for j in range(n))
    assert {(r.id, r.label): r.copies for r in found} == expected and sum(r.copies for r in found) == 5_100


def test_balanced(spark, table):
    found = resample.balanced(table, label="label", seed=1).collect()
    drawn = collections.Counter()
    for row in found:
        drawn[row.label] += row.copies
    assert drawn == {0: 1_500, 1: 1_500} or drawn == {0: 1_501, 1: 1_501}
    assert resample.balanced(table.limit(0), label="label").collect() == []
    other = resample.balanced(table, label="label", seed=2).collect()
    assert {r.id for r in other} != {r.id for r in found}
