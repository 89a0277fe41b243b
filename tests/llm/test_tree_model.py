import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom.llm import tree_model as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def trained(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 10 != 0


def base_scores(rows):
    count = Counter()
    for d, text in rows:
        if trained(d):
            count.update(WORD.findall((text or "").translate(LOWER)))
            count["\n"] += 1
    n, v = sum(count.values()), len(count)
    out = defaultdict(lambda: [0, 0, 0.0])
    for d, text in rows:
        for w in WORD.findall((text or "").translate(LOWER)) + ["\n"]:
            out[d][0] += 1
            out[d][1] += count.get(w, 0) > 0
            out[d][2] += math.log10((count.get(w, 0) + 0.1) / (n + 0.1 * (v + 1)))
    return out, n


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_base(table, request):
    df = request.getfixturevalue(table)
    want, n = base_scores([(r.doc_id, r.text) for r in df.collect()])
    got = {r.doc_id: r for r in T.score_corpus(df, ~T.held_out(F.col("doc_id"), 10, 0)).collect()}
    assert set(got) == set(want)
    for d, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not trained(d), want[d][0], want[d][1], n)
        assert r.base_score == pytest.approx(want[d][2], rel=1e-12)
        assert r.score < 0 and r.bits_per_byte < 9


def tree_scores(train, texts, depth=T.DEPTH):
    """Context-tree weighting with exact nodes and plain recursion."""
    zeros, ones, kids = Counter(), Counter(), defaultdict(set)

    def walk(text):
        data = text.translate(LOWER).encode() + b"\0"
        for i, byte in enumerate(data):
            before = tuple((data[i - k] if i >= k else 0) for k in range(1, depth + 1))
            for bit in range(8):
                prefix = (1 << bit) | (byte >> (8 - bit))
                yield [(before[:d], prefix) for d in range(depth + 1)], byte >> (7 - bit) & 1

    for text in train:
        for path, one in walk(text):
            for up, node in zip([None, *path], path):
                (ones if one else zeros)[node] += 1
                kids[up].add(node)

    def own(node):
        a, b = zeros[node], ones[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)

    weighted = {}

    def weight(node):
        if node not in weighted:
            if len(node[0]) == depth:
                weighted[node] = own(node)
            else:
                weighted[node] = np.logaddexp(own(node), sum(weight(k) for k in kids[node])) - math.log(2)
        return weighted[node]

    def p_one(path):
        p = None
        for node in reversed(path):
            n = zeros[node] + ones[node]
            mine = (ones[node] + 0.5) / (n + 1)
            w = math.exp(min(own(node) - math.log(2) - weight(node), 0)) if n else 0.5
            p = mine if p is None else w * mine + (1 - w) * p
        return p

    return [sum(math.log10(p_one(path) if one else 1 - p_one(path)) for path, one in walk(t)) for t in texts]


def test_tree_equals_plain_recursion(spark):
    train = ["Abra cadabra abracadabra", "le la les élan", "", "aaaa bbbb aaaa"]
    texts = ["abra", "élan la", "", "zq!", "aaaa\n" * 3]
    df = spark.createDataFrame([(t,) for t in train], "text string")
    model = spark.sparkContext.broadcast(T.train_tree(df))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc bigint, text string")
    got = rows.mapInArrow(T.score_texts(model), "doc bigint, words bigint, bytes bigint, score double").orderBy("doc").collect()
    assert [r.score for r in got] == pytest.approx(tree_scores(train, texts), rel=1e-9)


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 7.25, 1e3, 1e8])
    assert T.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-10, abs=1e-10)


def test_probabilities_add_up(spark):
    df = spark.createDataFrame([("some text to learn from, and more of it",)], "text string")
    model = T.train_tree(df)
    for context in (0, 0x20657400, 0x7A7A7A00):
        codes = (np.arange(256, dtype=np.uint32) | np.uint32(context)).astype(np.uint32)
        assert (10 ** T.log10_byte(codes, *model)).sum() == pytest.approx(1.0)


def test_learning_helps(documents):
    rows = T.score_corpus(documents, ~T.held_out(F.col("doc_id"), 10, 0)).where("held_out").collect()
    bits = sorted(r.bits_per_byte for r in rows)
    assert bits[len(bits) // 2] < 3.5  # letters alone take over four bits


def test_empty_and_clashing(empty, odd, clashing):
    learns = ~T.held_out(F.col("doc_id"), 10, 0)
    assert T.score_corpus(empty, learns).collect() == []
    no_training = T.score_corpus(odd, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.held_out for r in no_training)
    a, b = (sorted(map(str, T.score_corpus(x, learns).collect())) for x in (odd, clashing))
    assert a == b


def test_common_words_fill_no_bucket(documents, monkeypatch):
    """Words above the bar never reach a bucket with their documents; the scores stay."""
    df = documents.limit(60).localCheckpoint()
    want, n = base_scores([(r.doc_id, r.text) for r in df.collect()])
    monkeypatch.setattr(T, "COMMON_TIMES", 20, raising=False)
    weigh = T.weigh_words

    def bounded(bucket):
        for spread, times in zip(bucket.column("spread").to_pylist(), bucket.column("times").to_pylist()):
            assert T.unsqueeze(spread, np.uint32).max() < 20 and T.unsqueeze(times, np.uint32).max() < 20
        return weigh(bucket)

    monkeypatch.setattr(T, "weigh_words", bounded)
    got = {r.doc_id: r for r in T.score_corpus(df, ~T.held_out(F.col("doc_id"), 10, 0)).collect()}
    assert set(got) == set(want)
    for d, r in got.items():
        assert (r.n_known, r.train_tokens) == (want[d][1], n)
        assert r.base_score == pytest.approx(want[d][2], rel=1e-12)


@pytest.mark.parametrize("most", [1 << 21, 40])
def test_nodes_are_exact_on_many_contexts(spark, monkeypatch, most):
    """Scores over contexts that hashed slots would mix up, with few runs broadcast too."""
    import random

    monkeypatch.setattr(T, "COMMON_RUNS", most, raising=False)
    r = random.Random(3)
    rows = [(i, "".join(chr(r.choice([97, 98, 99, 0xE9, 0x4E00 + r.randint(0, 99)])) for _ in range(r.randint(0, 80)))) for i in range(40)]
    rows += [(40, "zq!"), (41, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {x.doc_id: x.score for x in T.score_corpus(df, F.col("doc_id") < 30).collect()}
    want = tree_scores([t for d, t in rows if d < 30], [t or "" for _, t in rows])
    assert [got[d] for d, _ in rows] == pytest.approx(want, rel=1e-9)


def test_a_context_has_one_parent():
    """More nodes of the deepest depth than two million stay apart."""
    codes = np.arange(0, 1 << 32, 1021, dtype=np.uint64).astype(np.uint32)[: 1 << 20]
    deepest = T.deep_levels(codes, np.ones(len(codes), np.int64))[0]
    assert len(deepest.key) > 1 << 21 and len(np.unique(deepest.key)) == len(deepest.key)
