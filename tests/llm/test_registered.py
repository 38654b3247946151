"""Registered queries and the pipeline over the given tables, against SQL or brute force."""

import base64
import collections
import hashlib
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
import tiktoken
from brute import kept_lines, near_groups, targets, words
from pyspark.sql import functions as F

import public_tokenizers
from sieveline.llm.oracle import SQL
from sieveline.llm.queries import QUERIES
from sieveline.llm.tables import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {row.doc_id: row for row in table(spark, SMALL, "documents").collect()}


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None


NATIVE = ("op2_", "op3_", "op4_", "op6_")


@pytest.mark.parametrize("name", [name for name in QUERIES if name.startswith(NATIVE)])
def test_native_plans(spark, plan, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not [node for node in ("Python", "Pandas", "Arrow", "Cartesian") if node in text]


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    connection = duckdb.connect()
    for view in ("documents", "conversations", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SMALL}/{view}.parquet'")
    result = connection.execute(SQL[name])
    columns = [column[0] for column in result.description]
    found = QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(result.fetchall())


def test_op1(spark, docs):
    rows = QUERIES["op1_compression_quality"](spark, SMALL).collect()
    labels = {row.doc_id: row.quality for row in table(spark, SMALL, "labels").collect()}
    assert {row.doc_id for row in rows} == set(docs)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in rows)
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    held = [row.predicted == labels[row.doc_id] for row in rows if row.held_out and row.doc_id in labels]
    assert sum(held) >= 0.85 * len(held)


def test_op3(spark, docs):
    rows = QUERIES["op3_hilbert_shards"](spark, SMALL).collect()
    counts = collections.Counter(row.shard for row in rows)
    assert len(rows) == len(docs) and max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(8))
    assert {(row.shard, row.slot) for row in rows} == {(shard, slot) for shard in counts for slot in range(counts[shard])}
    for row in rows:
        text = docs[row.doc_id].text.encode()
        assert (row.size, row.text_crc32, row.law) == (len(text) + 1, zlib.crc32(text), "rows")


def test_op5(spark, docs):
    rows = QUERIES["op5_feistel_pseudonyms"](spark, SMALL).collect()
    assert {row.doc_id for row in rows} == set(docs)
    for row in rows:
        text, at, new = docs[row.doc_id].text, 0, row.text
        assert row.n_replaced == len(row.spans) and len(new) >= 0
        for span in row.spans:
            assert text[at : span.start] in new and text[span.start : span.end] not in new
            at = span.end
        assert new.endswith(text[at:])


def test_op6(spark, docs):
    rows = QUERIES["op6_fair_mix"](spark, SMALL).collect()
    sizes = collections.Counter()
    for row in docs.values():
        sizes[row.source] += len(words(row.text))
    wanted, taken = targets(sizes), collections.Counter()
    for row in rows:
        source = docs[row.doc_id].source
        assert row.size == len(words(docs[row.doc_id].text)) and row.source_size == sizes[source]
        assert row.target == pytest.approx(wanted[source]) and 0 <= row.taken <= 3 * row.size
        taken[source] += row.taken
    largest = max(row.size for row in rows)
    assert all(abs(taken[source] - wanted[source]) <= 2 * largest for source in sizes)


def reader():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op9(spark, docs):
    library = reader()
    for row in QUERIES["op9_byte_bpe"](spark, SMALL).collect():
        text = docs[row.doc_id].text
        ids = library.encode_ordinary(text)
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_op11(spark, docs):
    rows = QUERIES["op11_language_families"](spark, SMALL).collect()
    assert {row.doc_id for row in rows} == set(docs)
    assert all(0 <= row.score <= 1 and row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in rows)
    held = [row.lang_pred == docs[row.doc_id].lang for row in rows if row.held_out and docs[row.doc_id].lang]
    assert sum(held) >= 0.95 * len(held)


def test_pipeline_stages(spark):
    """Each stage against a plain form of it, on what the stage before it kept."""
    before = table(spark, SMALL, "documents")
    steps = dict(corpus_pipeline.STAGES)
    columns = before.columns
    labels = {row.doc_id: row.quality for row in table(spark, SMALL, "labels").collect()}

    def run(name):
        nonlocal before
        after = steps[name](spark, before, SMALL).persist()
        rows = (before.collect(), after.collect())
        before = after
        return rows

    given, left = run("quality classifier")
    assert set(left) <= set(given) and before.columns == columns
    known = [row.doc_id for row in given if labels.get(row.doc_id) is not None]
    kept = {row.doc_id for row in left}
    assert sum((i in kept) == bool(labels[i]) for i in known) >= 0.9 * len(known)

    given, left = run("line dedup")
    truth = kept_lines({row.doc_id: row.text for row in given})
    assert {row.doc_id: row.text for row in left} == {i: text for i, (_, _, text) in truth.items()}
    assert all(row.n_chars == len(row.text) for row in left) and before.columns == columns

    given, left = run("minhash near-dedup")
    groups = near_groups({row.doc_id: row.text for row in given})
    assert {row.doc_id for row in left} == {i for i, (_, component) in groups.items() if i == component}
    assert before.columns == columns

    given, left = run("source mix")
    sizes, taken = collections.Counter(), collections.Counter()
    for row in given:
        sizes[row.source] += len(words(row.text))
    for row in left:
        taken[row.source] += len(words(row.text))
    assert max(collections.Counter(row.doc_id for row in left).values()) <= 3 and set(left) <= set(given)
    largest = max(len(words(row.text)) for row in given)
    assert all(abs(taken[source] - target) <= 2 * largest for source, target in targets(sizes).items())
    assert before.columns == columns

    given, left = run("byte-level bpe")
    library = reader()
    expected = collections.Counter((row.doc_id, np.array(library.encode_ordinary(row.text), "<u4").tobytes()) for row in given)
    assert collections.Counter((row.doc_id, bytes(row.ids)) for row in left) == expected


def test_pipeline_runs(spark):
    result = corpus_pipeline.run(spark, SMALL).join(table(spark, SMALL, "documents").select("doc_id"), "doc_id").collect()
    assert result and all(row.n_tokens > 0 and len(row.ids) == 4 * row.n_tokens for row in result)
    library = reader()
    for row in result:
        text = library.decode_bytes([int(n) for n in np.frombuffer(row.ids, "<u4")])
        assert row.decoded_sha256 == hashlib.sha256(text).hexdigest()


def odd_documents(spark):
    """The given documents with nulls, empty and repeated rows, and columns with names that stages use inside."""
    given = table(spark, SMALL, "documents").limit(60)
    odd = [(None, None, None, None, None), (-1, None, "en", "s", None), (-2, "", None, "s", 0), (-2, "", None, "s", 0), (-3, " \n\n ", "xx", None, 4)]
    rows = given.unionByName(spark.createDataFrame(odd, given.schema)).unionByName(given.limit(3))
    return rows.withColumns({name: F.lit(name) for name in ("score", "kept", "component_id", "size", "taken", "words", "ids", "_id", "n_tokens")})


def test_pipeline_stages_of_odd_documents(spark):
    docs = odd_documents(spark).persist()
    columns, ids = docs.columns, {row.doc_id for row in docs.select("doc_id").collect()}
    for n, (name, step) in enumerate(corpus_pipeline.STAGES):
        after = step(spark, docs, SMALL)
        rows = after.collect()
        assert {row.doc_id for row in rows} <= ids and rows, name
        assert after.columns == columns or n == len(corpus_pipeline.STAGES) - 1, name
        none = step(spark, docs.limit(0), SMALL)
        assert none.columns == after.columns and none.collect() == [], name
