import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sieveline.llm import hilbert

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("n, bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_each_cell_once_and_by_neighbours(spark, n, bits):
    cells = list(itertools.product(range(1 << bits), repeat=n))
    frame = spark.createDataFrame(cells, ", ".join(f"x{i} long" for i in range(n)))
    found = frame.withColumn("at", hilbert.curve_index([F.col(f"x{i}") for i in range(n)], bits)).collect()
    walk = [row[:n] for row in sorted(found, key=lambda row: row["at"])]
    assert [row["at"] for row in sorted(found, key=lambda row: row["at"])] == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(one, other)) == 1 for one, other in zip(walk, walk[1:]))


def corpus(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["", "é", "same text"]) + "x" * rng.randint(0, 900), rng.choice(["en", "de", None]), f"s{min(rng.randint(0, 30), 9)}") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("n, shards", [(1003, 8), (5, 8), (64, 3)])
def test_law_of_rows(spark, n, shards):
    docs = corpus(spark, n)
    texts = {row.doc_id: row.text.encode() for row in docs.collect()}
    placed = hilbert.shard(docs.repartition(5), shards=shards).collect()
    assert len(placed) == n
    by_shard = {}
    for row in placed:
        assert (row.size, row.text_crc32) == (len(texts[row.doc_id]) + 1, zlib.crc32(texts[row.doc_id]))
        by_shard.setdefault(row.shard, []).append(row)
    counts = [len(by_shard.get(shard, [])) for shard in range(shards)]
    assert max(counts) - min(counts) <= 1
    for rows in by_shard.values():
        rows.sort(key=lambda row: row.slot)
        assert [row.slot for row in rows] == list(range(len(rows)))
        assert [row.curve for row in rows] == sorted(row.curve for row in rows)
    firsts = [(by_shard[s][0].curve, by_shard[s][-1].curve) for s in sorted(by_shard)]
    assert all(last <= first for (_, last), (first, _) in zip(firsts, firsts[1:]))


def test_partitions_agree(spark):
    docs = corpus(spark, 300)
    answers = [sorted(map(tuple, hilbert.shard(docs.repartition(n)).collect())) for n in (1, 6)]
    assert answers[0] == answers[1]


def test_edges(spark):
    rows = [(None, None, None, None), (None, None, None, None), (1, "", "en", "a"), (1, "", "en", "a"), (2, "x" * 200_000, "en", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = docs.withColumns({name: F.lit(name) for name in ("size", "shard", "slot", "_rank", "_part", "curve", "_id")})
    placed = hilbert.shard(docs, dimensions=("lang", "source", "size"), shards=2).collect()
    assert sorted(row.size for row in placed) == [1, 1, 1, 1, 200_001]
    assert sorted((row.shard, row.slot) for row in placed) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
    assert hilbert.shard(docs.limit(0)).count() == 0


def test_files_span_small_ranges(spark, tmp_path):
    docs = corpus(spark, 2000)
    path = str(tmp_path / "shards")
    hilbert.write_shards(docs, path, slots=100)
    written = spark.read.parquet(path).withColumn("file", F.input_file_name())
    assert sorted(map(tuple, written.select(docs.columns).collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    size = F.octet_length("text")
    spans = written.groupBy("file").agg((F.max(size) - F.min(size)).alias("size"), F.countDistinct("source").alias("sources"), F.count("*").alias("n")).collect()
    assert max(row.n for row in spans) <= 100
    full = [row for row in spans if row.n > 50]
    assert sum(row.size for row in full) / len(full) < 600 and sum(row.sources for row in full) / len(full) < 7


def test_names_with_a_common_prefix(spark):
    rng = random.Random(5)
    # A third of all rows has one value.
    names = [None if rng.random() < 0.1 else f"https://example.org/source_{rng.choice([3, rng.randint(0, 90), rng.randint(0, 90)]):02d}" for _ in range(900)]
    docs = spark.createDataFrame([(i, name, i % 7) for i, name in enumerate(names)], "doc_id long, source string, n long")
    leveled, (source, n) = hilbert.levels(docs.repartition(4), ["source", "n"], 5)
    found = {row.doc_id: (row.a, row.b) for row in leveled.select("doc_id", source.alias("a"), n.alias("b")).collect()}
    known = sorted(name for name in names if name)
    expected = {name: known.index(name) * 32 // len(known) for name in set(known)}
    assert {i: a for i, (a, _) in found.items()} == {i: expected.get(name, 0) for i, name in enumerate(names)}
    assert len({a for a, _ in found.values()}) > 15 and [found[i][1] for i in range(7)] == sorted({b for _, b in found.values()})


def plain_curve(point, bits):
    """Index along the Hilbert curve by recursion on the state of a cell: its entry corner and its direction."""
    n, entry, direction, index = len(point), 0, 0, 0
    rotate = lambda x, k: ((x >> k % n) | (x << (n - k % n))) & ((1 << n) - 1)
    gray = lambda x: x ^ (x >> 1)
    for b in range(bits - 1, -1, -1):
        corner = sum((point[axis] >> b & 1) << (n - 1 - axis) for axis in range(n))
        turned = rotate(corner ^ entry, direction + 1)
        place = next(w for w in range(1 << n) if gray(w) == turned)
        index = index << n | place
        first = 0 if place == 0 else gray(2 * ((place - 1) // 2))
        ones = lambda x: next(k for k in range(n + 1) if not x >> k & 1)
        side = 0 if place == 0 else ones(place - 1) % n if place % 2 == 0 else ones(place) % n
        entry ^= ((first << (direction + 1) % n) | (first >> (n - (direction + 1) % n))) & ((1 << n) - 1)
        direction = (direction + side + 1) % n
    return index


def test_cells_of_a_run_are_those_of_a_plain_curve(spark):
    """Both curves fill each aligned block of cells before they leave it, in whatever orientation."""
    cells = list(itertools.product(range(8), repeat=3))
    frame = spark.createDataFrame(cells, "x long, y long, z long")
    ours = {row[:3]: row["at"] for row in frame.withColumn("at", hilbert.curve_index([F.col(c) for c in "xyz"], 3)).collect()}
    plain = {cell: plain_curve(cell, 3) for cell in cells}
    assert sorted(plain.values()) == sorted(ours.values()) == list(range(512))
    for curve in (ours, plain):
        for size in (1, 2, 4):
            runs = {}
            for cell, at in curve.items():
                runs.setdefault(tuple(x // size for x in cell), set()).add(at // size**3)
            assert all(len(run) == 1 for run in runs.values())
