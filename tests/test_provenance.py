import random

import pytest

from sieveline.operators import citation_index, citations, provenance
from sieveline.staging import staged_path


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(6)
    hub = [(f"W{n}", "W3") for n in range(200, 400)]
    return hub + [(f"W{rng.randint(0, 300)}", f"W{rng.randint(0, 300)}") for _ in range(900)] + [("W1", None), (None, "W3")]


@pytest.fixture(scope="module")
def edges(spark, pairs):
    return spark.createDataFrame(pairs + pairs[:40], "citing string, cited string").cache()


def ids(spark, names):
    return spark.createDataFrame([(name,) for name in names], "id string")


def led(pairs, seeds, review):
    """{id: (level, seeds, cites)} by plain sets."""
    cited = {}
    for citing, one in pairs:
        if citing and one:
            cited.setdefault(citing, set()).add(one)
    first = {work: refs & seeds for work, refs in cited.items() if refs & seeds}
    found = {work: ("primary", sorted(refs), sorted(refs)) for work, refs in first.items()}
    for work, refs in cited.items():
        if work not in first and (via := refs & first.keys()):
            found[work] = ("secondary", sorted(set().union(*(first[one] for one in via))), sorted(via))
    return {work: what for work, what in found.items() if work not in review}


# More seeds than one word of the bitmaps has bits; all ways of the joins.
@pytest.mark.parametrize(("rows", "hot_rows"), [(500_000, 500), (10, 50), (0, 1_000_000)])
@pytest.mark.parametrize("n_seeds", [1, 150])
def test_provenance(spark, edges, pairs, rows, hot_rows, n_seeds):
    seeds, review = [f"W{n}" for n in range(3, 3 + n_seeds)], {"W7", "W3", "W210"}
    found = provenance.snowball_provenance(
        edges.repartition(5), ids(spark, [*seeds, *seeds[:3], None]), ids(spark, [*review, None]), rows, hot_rows
    )
    rows_of = {row.id: (row.level, row.seeds, row.cites) for row in found.collect()}
    assert found.count() == len(rows_of) and rows_of == led(pairs, set(seeds), review)


def test_no_seeds_and_no_edges(spark, edges):
    none = ids(spark, [])
    assert provenance.snowball_provenance(edges, none, none).collect() == []
    assert provenance.snowball_provenance(edges.limit(0), ids(spark, ["W3"]), none).collect() == []


@pytest.mark.parametrize("hot_rows", [1_000_000, 100])
def test_index_after_appends(spark, edges, pairs, plan, hot_rows):
    path = staged_path(spark, "index")
    old, new = edges.where("citing < 'W2'"), edges.where("NOT citing < 'W2'")
    index = citation_index.create_index(spark, path, old, 4, hot_rows).append(new, hot_rows).append(new, hot_rows)
    assert (index.hot.count() > 0) == (hot_rows == 100)
    # Another run opens the same files.
    index = citation_index.CitationIndex(spark, path, 4)
    asked, review = ids(spark, ["W3", "W5", "W5", None, "W9999"]), ids(spark, ["W7", None])
    for rows in (500_000, 0):
        links = {(r.citing, r.cited) for r in index.links(asked, rows).collect()}
        assert links == {(a, b) for a, b in pairs if a and b in ("W3", "W5")}
        found = {r.id: r.level for r in index.snowball(asked, review, rows).collect()}
        assert found == {r.id: r.level for r in citations.snowball(edges.dropna(), asked, review).collect()}


def test_lookup_does_not_shuffle_the_edges(spark, edges):
    index = citation_index.create_index(spark, staged_path(spark, "index"), edges, 4)
    found = index.links(edges.selectExpr("cited AS id"), rows=0)
    text = found._jdf.queryExecution().executedPlan().toString()
    joins = [part for part in text.split("SortMergeJoin")[1:]]
    assert joins and "Bucketed: true" in text
    # Between the first join and the scan of the buckets there is no exchange.
    left = joins[0][: joins[0].index("Bucketed: true")]
    assert "Exchange" not in left
