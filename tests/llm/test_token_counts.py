import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from pathloom.llm.token_counts import VOCABULARY, LengthTable, Texts, Vocabulary, cut_long, frequent_lengths, token_counts

PARTS = [" ", "  ", "\n", "\t", "a", "b'", "'s", "'ll", "é", "中", "½", "<|endoftext|>", "<|endof", "text|>", "1", "23", "!", " ", "　", "\x1c", "🙂", "x" * 50, "word ", "the "]


def brute(text):
    return len(Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_counts(table, request):
    df = request.getfixturevalue(table)
    got = token_counts(df, keep=["doc_id", "text"]).collect()
    assert len(got) == df.count()
    for r in got:
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), brute(r.text)), r.doc_id
        assert r.over_limit == (r.n_tokens > 512)


def test_random_texts_with_small_tables(spark):
    """Added tokens inside and across texts, odd white space; a table and a cache that
    nearly everything misses give the same counts."""
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 50))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    want = {i: brute(t) for i, t in enumerate(texts)}
    for sizes in ({}, {"table_size": 5, "cache_size": 3}, {"sample_docs": 10}):
        assert {r.doc_id: r.n_tokens for r in token_counts(df, **sizes).collect()} == want


def test_long_texts_are_cut_where_a_piece_begins(spark):
    rnd = random.Random(3)
    text = "".join(rnd.choice(PARTS) + "word one " for _ in range(3000))
    buf = np.frombuffer(text.encode(), np.uint8)
    parts = [p.buf.tobytes().decode() for p in cut_long(Texts(buf, np.array([0, len(buf)])), limit=5000)]
    assert "".join(parts) == text and len(parts) > 5 and max(map(len, parts)) < 12_000
    assert sum(map(brute, parts)) == brute(text)
    long = "some words here " * 300_000 + "<|endoftext|>" + "y" * 10
    got = token_counts(spark.createDataFrame([(1, long), (2, "z" * 3_000_000)], "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {1: brute(long), 2: brute("z" * 3_000_000)}


def test_length_table():
    rnd = np.random.default_rng(0)
    keys = np.unique(rnd.integers(1, 1 << 63, 5000).astype(np.uint64))
    table = LengthTable(keys, (keys % np.uint64(200) + np.uint64(1)).astype(np.uint8))
    assert (table.lookup(keys) == keys.astype(np.int64) % 200 + 1).all()
    assert (table.lookup(keys ^ np.uint64(1 << 5)) == 0).mean() > 0.99
    none = LengthTable(keys[:0], np.empty(0, np.uint8))
    assert (none.lookup(keys) == 0).all()


def test_table_holds_the_frequent_ones(spark):
    rows = [(i, "common words all over " + f"rare{i}") for i in range(300)]
    table = frequent_lengths(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text", table_size=4)
    assert (table.keys != 0).sum() == 4 and set(table.lengths[table.keys != 0].tolist()) == {1}


def test_empty_and_clashing(empty, odd, clashing):
    assert token_counts(empty).collect() == []
    more = clashing.withColumnRenamed("x", "n_tokens").withColumnRenamed("y", "_t").withColumnRenamed("w", "_n")
    keep = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(str, token_counts(more).select(keep).collect())) == sorted(map(str, token_counts(odd).select(keep).collect()))


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
