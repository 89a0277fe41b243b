"""Each stage of the pipeline on its own input, against what it must keep."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

from .test_near_dedup import brute as near
from .test_personal_data import brute as personal
from .test_quality_rules import brute as quality


@pytest.fixture(scope="module")
def kept(spark, documents, sf, tmp_path_factory):
    """The rows of every stage, written and read again."""
    docs, out = documents, {"input": documents}
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_columns(kept):
    names = [n for n, _ in P.STAGES]
    assert names == ["quality_rules", "near_dedup", "decontamination", "personal_data", "packing"]
    for name in names[:-1]:
        assert kept[name].dtypes == kept["input"].dtypes


def test_quality(kept):
    good = {r.doc_id for r in kept["input"].collect() if not quality(r.text)[-1]}
    assert {r.doc_id for r in kept["quality_rules"].collect()} == good


def test_near_dedup(kept):
    want = {d for d, _, _, k in near([(r.doc_id, r.text) for r in kept["quality_rules"].collect()]) if k}
    assert {r.doc_id for r in kept["near_dedup"].collect()} == want


def test_decontamination(spark, kept, sf):
    words = lambda t: [w.strip(".,;:!?#$%&*|") for w in t.lower().split()]
    bench = [words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = {tuple(w[i : i + 13]) for w in bench for i in range(len(w) - 12)}
    before = {r.doc_id: words(r.text) for r in kept["near_dedup"].collect()}
    bad = {d for d, w in before.items() if any(tuple(w[i : i + 13]) in grams for i in range(len(w) - 12))}
    after = {r.doc_id for r in kept["decontamination"].collect()}
    assert not after & bad
    assert len(before) - len(after) <= len(bad) + 0.01 * len(before)


def test_personal_data(kept):
    before = {r.doc_id: r for r in kept["decontamination"].collect()}
    after = {r.doc_id: r for r in kept["personal_data"].collect()}
    assert set(before) == set(after)
    for d, r in after.items():
        assert r.n_chars == len(r.text) and not personal(r.text)
        if not any(c.isdigit() or c == "@" for c in before[d].text):
            assert r.text == before[d].text


def test_packing(kept):
    pieces = kept["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("want")).collect()
    assert all(r.n == r.want for r in pieces)
    assert {r.doc_id for r in pieces} == {r.doc_id for r in kept["personal_data"].collect()}


def test_packing_returns_the_tokens(kept):
    """The ids of the pieces, joined, are those of every whole text and its end id."""
    import public_tokenizers
    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = {}
    for r in sorted(kept["packing"].collect(), key=lambda r: r.start):
        assert len(r.ids) == r.length
        docs.setdefault(r.doc_id, []).extend(r.ids)
    want = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in kept["personal_data"].collect()}
    assert docs == want


def test_run(spark, kept, sf):
    assert P.run(spark, sf).count() == kept["packing"].count()


def test_odd_tables(spark, odd, empty, clashing, sf):
    for table in (odd, empty, clashing):
        docs = table
        for name, stage in P.STAGES:
            docs = stage(spark, docs, sf)
            assert name == "packing" or docs.columns == list(P.COLUMNS)
        docs.collect()


def test_repeated_rows(spark, odd, sf):
    got = P.near_dedup(spark, odd, sf).groupBy("doc_id").count().collect()
    assert all(r["count"] == 1 for r in got)


def test_rows_without_an_id_of_their_own(spark, sf):
    """Clean, different texts stay though they share an id or have none."""
    from .conftest import DOCS, prose, with_changes

    passage = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    texts = [prose(100 + i, 80) for i in range(6)]
    rows = [(d, t, "en", "a", 1) for d, t in zip([None, None, None, 7, 7, 8], texts)]
    copies = [(9, with_changes(texts[0], [40]), "en", "a", 1), (10, with_changes(texts[1], [40]), "en", "a", 1)]
    bad = [(None, passage, "en", "a", 1), (7, passage + " " + prose(3, 5), "en", "a", 1)]
    docs = spark.createDataFrame(rows + copies, DOCS)
    assert sorted(r.text for r in P.near_dedup(spark, docs, sf).collect()) == sorted(texts)
    docs = spark.createDataFrame(rows + bad, DOCS)
    assert sorted(r.text for r in P.decontamination(spark, docs, sf).collect()) == sorted(texts)
