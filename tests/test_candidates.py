import pytest
from pyspark.sql import functions as F

from sieveline.operators import candidates, responses
from sieveline.plans import screening

HITS = "query_pos long, query_id string, rank int, id string"


@pytest.fixture
def hits(spark):
    return spark.createDataFrame(
        [
            (0, "q0", 0, "A"),
            (0, "q0", 1, "B"),
            (0, "q0", 9, "X"),
            (1, "q1", 0, "C"),
            (1, "q1", 1, "A"),
            (1, "q1", 2, "X"),
        ],
        HITS,
    )


def test_first_list_decides_not_the_lowest_rank(hits):
    kept = {r.id: (r.query_pos, r["rank"]) for r in candidates.keep_first(hits).collect()}
    assert kept == {"A": (0, 0), "B": (0, 1), "X": (0, 9), "C": (1, 0)}
    cut = {r.id: r["rank"] for r in candidates.keep_first(candidates.cut(hits, 9)).collect()}
    assert cut["X"] == 2


def test_keep_first_combines_before_the_shuffle(hits, plan):
    text = plan(candidates.keep_first(hits))
    assert "partial_min_by" in text and "Window" not in text


@pytest.fixture
def works(spark):
    return spark.createDataFrame(
        [("A", "d1", "ta", None), ("B", None, None, "ab"), ("M", "d3", "tm", "am")],
        "id string, doi string, title string, abstract string",
    )


def test_merged_work_has_no_rank_and_comes_last(spark, hits, works):
    merged = spark.createDataFrame([("X", "M"), ("C", "M")], "old_id string, new_id string")
    ranked = candidates.keep_first(hits).select("id", "rank")
    found = candidates.ranked_dataset(ranked, works, "rank", merged=merged).collect()
    assert [(r.id, r["rank"]) for r in found] == [("A", 0), ("B", 1), ("M", None)]
    assert [r.id for r in candidates.unresolved(ranked, works).orderBy("id").collect()] == ["C", "X"]


def test_nulls_last_in_either_direction(spark, works):
    values = spark.createDataFrame([("A", 0.5), ("B", None), ("M", 0.9)], "id string, score double")
    for descending, first in ((True, "M"), (False, "A")):
        rows = candidates.ranked_dataset(values, works, "score", descending=descending).collect()
        assert rows[0].id == first and rows[-1].id == "B"


def test_dataset_has_full_ids(hits, works):
    rows = screening.included_dataset(hits, works, cut=5).collect()
    assert [r.id for r in rows] == ["https://openalex.org/A", "https://openalex.org/B"]
    assert rows[0].asDict() == {
        "id": "https://openalex.org/A", "doi": "d1", "title": "ta", "abstract": None, "rank": 0,
    }


def test_works_are_filtered_in_place(hits, works, plan):
    text = plan(candidates.enrich(hits, works, ("id", "title")))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_histogram_identities(hits):
    histogram = responses.frequency_histogram(hits).collect()
    assert sum(r.n_records for r in histogram) == responses.distinct_ids(hits).first().n_ids == 4
    assert sum(r.n_responses * r.n_records for r in histogram) == hits.count()
    assert [tuple(r) for r in responses.frequency(hits).collect()] == [("A", 2), ("X", 2), ("B", 1), ("C", 1)]


def test_discovery_curve(hits):
    curve = responses.discovery_curve(hits, 10).orderBy("rank").collect()
    assert [r.n_ids for r in curve] == [2, 3, 4, 4, 4, 4, 4, 4, 4, 4]
    assert [r.new_ids for r in curve] == [0, 1, 1, 0, 0, 0, 0, 0, 0, 0]


@pytest.mark.parametrize(
    "target, expected", [(3, (2, 3, 2, 3)), (1, (None, None, 1, 2)), (9, (10, 4, None, None)), (4, (10, 4, 3, 4))]
)
def test_choose_cutoff(hits, target, expected):
    assert tuple(responses.choose_cutoff(hits, target, 10).first()) == expected


def test_overlap(hits):
    found = {(r.query_a, r.query_b): r.n_common for r in responses.overlap(hits, hits).collect()}
    assert found == {(0, 0): 3, (0, 1): 2, (1, 0): 2, (1, 1): 3}


def test_overlap_joins_no_hits_with_hits(hits, plan):
    text = plan(responses.overlap(hits, hits))
    assert "Join" not in text and "CartesianProduct" not in text


def test_membership_ignores_repeated_and_null_keys(spark, hits):
    other = spark.createDataFrame([("A",), ("A",), (None,)], "id string")
    lists = hits.select(F.lit("all").alias("list"), "id")
    assert tuple(responses.membership(lists, {"n": other}, "list").first()) == ("all", 4, 1)
    assert responses.count_members(hits, other).first().n_ids == 1


def test_preview(hits):
    assert [r.id for r in candidates.preview(hits, "rank", "id", n=2).collect()] == ["A", "C"]
