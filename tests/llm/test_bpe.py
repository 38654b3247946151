import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sieveline.llm import bpe
from sieveline.llm.queries import bpe_pattern, vocabulary


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reader(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


WORDS = st.one_of(st.binary(min_size=1, max_size=20), st.text("aesthrn tionlyé", min_size=1, max_size=120).map(str.encode))


def test_both_ways_of_merging_agree(ranks):
    @settings(max_examples=300, deadline=None)
    @given(WORDS)
    def agree(word):
        if word not in ranks:
            assert bpe._merge_long(word, ranks) == bpe._merge_short(word, ranks)

    agree()


def test_against_the_library(spark, ranks, reader):
    texts = [
        "", None, " ", "\n\n\n x", "it's  we'll\tdon't 'S", "café naïve 你好 \U0001f600 ́", "a b c\u0085d\x1ce", "1234567 ١٢ ½",
        "word " * 40_000, "x" * 20_000, "ab" * 3000 + " tail", "<|endoftext|>", "\x00\x01\r\n \r", "trailing  ", "  leading", " 　mixed ",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    docs = docs.withColumns({name: F.lit(name) for name in ("words", "ids", "n_tokens", "decoded")})
    packed = bpe.encode(docs, ranks, bpe_pattern())
    rows = bpe.decode(packed, ranks).collect()
    assert len(rows) == len(texts)
    listed = bpe.decode(bpe.encode(docs, ranks, bpe_pattern(), tokens=True), ranks)
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, rows))
    for row in rows:
        text = texts[row.doc_id] or ""
        ids = reader.encode_ordinary(text)
        assert [int.from_bytes(row.ids[n : n + 4], "little") for n in range(0, len(row.ids), 4)] == ids
        assert row.n_tokens == len(ids) and bytes(row.decoded) == text.encode()


def test_kept_columns_null_and_repeated_ids(spark, ranks):
    rows = [(None, "some text", "a"), (3, "some text", None), (3, "some text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = bpe.encode(docs, ranks, bpe_pattern(), keep=("source",))
    assert found.columns == ["doc_id", "n_tokens", "ids", "source"]
    assert len({bytes(row.ids) for row in found.collect()}) == 1 and found.count() == 3
    assert bpe.encode(docs.limit(0), ranks, bpe_pattern()).count() == 0
    nulls = spark.createDataFrame([(1, 0, None)], bpe.ENCODED)
    assert bpe.decode(nulls, ranks).first().decoded is None


def test_words_beyond_the_cache(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    merged = bpe._Merged(ranks)
    first = [merged[word] for word in (b" one", b" twothing", b"xyzzyx", b"qwxkj", b"zzzq", b" one")]
    assert len(merged) <= 3 and first[0] == first[-1]


def test_folding_agrees(spark, ranks):
    texts = ["café naïve 你好 \U0001f600", "it's  we'll xyzzyx qwxkj zzzq", "", None, "a", "aab" * 15, "thsheing onouthnt " * 3, "\x00\r\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packed = {row.doc_id: list(row.tokens) for row in bpe.encode(docs, ranks, bpe_pattern(), tokens=True).collect()}
    assert {row.doc_id: list(row.tokens) for row in bpe.encode_folded(docs, ranks, bpe_pattern()).collect()} == packed
