"""Scores of texts by a context-tree weighting model of bytes, and by word counts.

A byte is eight binary choices.  A choice is known by the bits of its byte so far
and by 0 to ``DEPTH`` bytes before it; each such node holds counts of zeros and
ones and gives a Krichevsky-Trofimov estimate.  The weighted probability of a node
is half its own estimate and half the product of its children's, which mixes the
estimates of all depths.  The score of a text is the log10 of the product over its
lower-cased bytes and one end byte, with the counts of the training documents.

Counting is distributed: tasks count runs of ``DEPTH + 1`` bytes and Spark adds them
up.  Nodes are exact.  Runs with the same two bytes before their last one lie in one
bucket, so a bucket knows all nodes of depth 2 and 3 below each other (at most 65,280
of depth 3 for each of depth 2); it sends what they add to the nodes above, of which
there are 65,535 at most, weighed on the driver.  With those broadcast the buckets give
the probability of every run.  The ``COMMON_RUNS`` commonest runs are broadcast with
theirs; the others of a document are joined with the table of runs.

The base score is a unigram model of words.  Words are counted first, each sent once
per group of documents to the bucket of its hash.  The commonest (``COMMON_TIMES``
occurrences and a ``COMMON_WORDS``-th of all at least, so at most ``COMMON_WORDS`` of
them) are broadcast with their counts and weighed where the documents are.  Every other
word is sent once per group to its bucket with the documents it stands in; the bucket
sends back sums by document.  So no word's documents fill a bucket, and the vocabulary
does not pass through the driver.

Defined results: a null text is empty and has the end token alone; a null doc_id
counts as the empty string for the choice of documents held out; rows that share
a doc_id are one document whose figures are sums over its rows; with no training
document every estimate is one half and N is 0; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import query, step, table
from pathloom.llm.substring_dedup import runs, squeeze, unsqueeze
from pathloom.llm.textcols import LOWER, NO_ID, U64, Texts, int64_column, slices

DEPTH = 3
#: Text bytes per word bucket, words per sorted group, runs held by a task.
BUCKET_BYTES = 32 << 20
GROUP_WORDS = 1 << 20
HELD_RUNS = 1 << 21
#: Runs broadcast at most, and runs per bucket of the tree.
COMMON_RUNS, BUCKET_RUNS = 1 << 21, 200_000
#: Occurrences of a common word at least, and common words at most.
COMMON_TIMES, COMMON_WORDS = 1 << 15, 100_000


def held_out(doc_id: Column, parts: int, rest: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts == rest


# --- the tree ---------------------------------------------------------------


def byte_runs(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and each end: it and the bytes before it as one number, and
    its document.  Before a text stand zeros."""
    n = len(texts)
    size = np.diff(texts.off) + 1
    border = np.concatenate([[0], np.cumsum(size)])
    flat = np.zeros(border[-1], np.uint8)
    doc = np.repeat(np.arange(n), size)
    place = np.ones(border[-1], bool)
    place[border[1:] - 1] = False
    flat[place] = LOWER[texts.buf]
    code = flat.astype(np.uint32)
    since = np.arange(border[-1]) - border[doc]
    for k in range(1, DEPTH + 1):
        before = np.zeros(len(flat), np.uint32)
        before[k:] = flat[:-k]
        before[since < k] = 0
        code |= before << np.uint32(8 * k)
    return code, doc


def count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each run occurs; its number is doubled, and one more in training texts."""
    held, times = np.empty(0, U64), np.empty(0, np.int64)

    def out() -> Iterator[pa.RecordBatch]:
        for a in range(0, len(held), 100_000):
            cols = [pa.array(held[a : a + 100_000].astype(np.int64)), pa.array(times[a : a + 100_000])]
            yield pa.RecordBatch.from_arrays(cols, names=["code", "n"])

    for batch in batches:
        learns = batch.column(1).to_numpy(zero_copy_only=False).astype(U64)
        for a, _, texts in slices(batch.column(0)):
            code, doc = byte_runs(texts)
            code = code.astype(U64) << U64(1) | learns[a + doc]
            code.sort()
            first, count = runs(code)
            both, n = np.concatenate([held, code[first]]), np.concatenate([times, count])
            order = np.argsort(both, kind="stable")
            both, n = both[order], n[order]
            first, _ = runs(both)
            held, times = both[first], np.add.reduceat(n, first) if len(n) else n
            if len(held) > HELD_RUNS:
                yield from out()
                held, times = held[:0], times[:0]
    yield from out()


def node_keys(code: np.ndarray, depth: int, bit: int) -> np.ndarray:
    """Depth, context and prefix, as one number, of the node that decides ``bit`` (0 is
    the highest) of the last byte."""
    prefix = (np.uint32(1) << np.uint32(bit)) | ((code & np.uint32(255)) >> np.uint32(8 - bit))
    context = (code >> np.uint32(8)).astype(U64) & U64((1 << (8 * depth)) - 1)
    return U64(depth << 40) | context << U64(8) | prefix.astype(U64)


def parents(key: np.ndarray, depth: int) -> np.ndarray:
    """The nodes one byte of context above those of ``depth``."""
    return U64((depth - 1) << 40) | key & U64((1 << (8 * depth)) - 1)


def added(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different keys in order, and the sums of the values of each."""
    lead, at = np.unique(key, return_inverse=True)
    return lead, *(np.bincount(at, weights=v, minlength=len(lead)) for v in values)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for x > 0, by Stirling's series at x + 8."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    tail = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) + 1 / (1188 * y**9)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + tail - shift


class Level:
    """Nodes of one depth: the estimate that their bit is one, their weighted
    probability, and the weight of the estimate against the deeper ones."""

    def __init__(self, depth: int, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        self.depth, self.key, self.zeros, self.ones = depth, key, zeros, ones
        own = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - 2 * math.lgamma(0.5) - log_gamma(zeros + ones + 1.0)
        self.weighted = own if depth == DEPTH else np.logaddexp(own, below) - math.log(2)
        self.weight = np.exp(np.minimum(own - math.log(2) - self.weighted, 0.0))
        self.estimate = (ones + 0.5) / (zeros + ones + 1.0)

    def above(self) -> tuple[np.ndarray, ...]:
        """Keys, zeros, ones and weighted mass below for the nodes above."""
        return added(parents(self.key, self.depth), self.zeros, self.ones, self.weighted)


def deep_levels(code: np.ndarray, n: np.ndarray) -> list[Level]:
    """The nodes of depth ``DEPTH`` and the depth above, from all runs below the latter."""
    code, n = code[n > 0], n[n > 0]
    found = []
    for bit in range(8):
        one = (code >> np.uint32(7 - bit)) & np.uint32(1) == 1
        found.append((node_keys(code, DEPTH, bit), n * ~one, n * one))
    key, zeros, ones = added(*(np.concatenate(x) for x in zip(*found)))
    deepest = Level(DEPTH, key, zeros, ones, np.zeros(len(key)))
    return [deepest, Level(DEPTH - 1, *deepest.above())]


def top_levels(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> list[Level]:
    """The nodes of depth ``DEPTH - 2`` and less."""
    out = [Level(DEPTH - 2, key, zeros, ones, below)]
    while out[-1].depth:
        out.append(Level(out[-1].depth - 1, *out[-1].above()))
    return out


def tree_of(levels: list[Level]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, estimates and weights of all nodes."""
    levels = sorted(levels, key=lambda x: x.depth)
    return tuple(np.concatenate([getattr(x, part) for x in levels]) for part in ("key", "estimate", "weight"))


def log10_byte(code: np.ndarray, key: np.ndarray, estimate: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """log10 of the probability of the last byte of each run after the others; a node
    without counts gives one half."""
    key, estimate, weight = np.append(key, ~U64(0)), np.append(estimate, 0.5), np.append(weight, 0.5)
    total = np.zeros(len(code))
    for bit in range(8):
        p = None
        for depth in range(DEPTH, -1, -1):
            node = node_keys(code, depth, bit)
            at = np.searchsorted(key, node)
            at[key[at] != node] = len(key) - 1
            own = estimate[at]
            p = own if p is None else weight[at] * own + (1.0 - weight[at]) * p
        one = (code >> np.uint32(7 - bit)) & np.uint32(1) == 1
        total += np.log10(np.where(one, p, 1.0 - p))
    return total


def run_table(docs: DataFrame, text: str, learns: Column) -> DataFrame:
    """Every run: code, occurrences in all texts (n) and in training texts (learnt)."""
    counted = docs.select(F.col(text).cast("string"), learns).mapInArrow(count_runs, "code bigint, n bigint")
    learnt = F.when(F.col("code").bitwiseAND(1) == 1, F.col("n")).otherwise(0)
    counted = counted.select(F.shiftright("code", 1).alias("code"), "n", learnt.alias("learnt"))
    return step(counted.groupBy("code").agg(F.sum("n").alias("n"), F.sum("learnt").alias("learnt")), "byte_runs")


def run_columns(table_: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return table_.column("code").to_numpy().astype(np.uint32), table_.column("learnt").to_numpy()


def train_tree(train: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tree of ``train`` in memory: keys, estimates and weights.  For small tables;
    ``log10_runs`` gives the same without gathering the nodes."""
    deep = deep_levels(*run_columns(run_table(train, text, F.lit(True)).toArrow()))
    return tree_of(deep + top_levels(*deep[-1].above()))


TOP = pa.schema([("key", pa.int64()), ("zeros", pa.float64()), ("ones", pa.float64()), ("below", pa.float64())])


def send_up(bucket: pa.Table) -> pa.Table:
    """What the runs of a bucket add to the nodes above the two deepest depths."""
    key, *sums = deep_levels(*run_columns(bucket))[-1].above()
    return pa.table([pa.array(key.astype(np.int64)), *map(pa.array, sums)], schema=TOP)


def score_runs(top):
    """The log10 probability of each run of a bucket."""

    def run(bucket: pa.Table) -> pa.Table:
        code, learnt = run_columns(bucket)
        deep = tree_of(deep_levels(code, learnt))
        score = log10_byte(code, *(np.concatenate(x) for x in zip(top.value, deep)))
        return pa.table([bucket.column("code"), bucket.column("n"), pa.array(score)], names=["code", "n", "score"])

    return run


def log10_runs(all_runs: DataFrame) -> DataFrame:
    """code, n and score (log10 probability) of every run of :func:`run_table`."""
    buckets = all_runs.count() // BUCKET_RUNS + 12
    above = F.shiftright("code", 8).bitwiseAND((1 << (8 * (DEPTH - 1))) - 1)
    placed = all_runs.groupBy(F.pmod(F.xxhash64(above), F.lit(buckets)))
    sums = placed.applyInArrow(send_up, "key bigint, zeros double, ones double, below double").groupBy("key")
    got = step(sums.agg(*[F.sum(c).alias(c) for c in TOP.names[1:]]), "top_nodes").orderBy("key").toArrow()  # 65,280 rows at most
    key, *sums = (got.column(c).to_numpy() for c in TOP.names)
    top = all_runs.sparkSession.sparkContext.broadcast(tree_of(top_levels(key.astype(U64), *sums)))
    return step(placed.applyInArrow(score_runs(top), "code bigint, n bigint, score double"), "run_scores")


def common_runs(scored: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], DataFrame]:
    """The commonest runs in order with their scores, ``COMMON_RUNS`` at most, and the
    table of the others."""
    band = F.floor(8 * F.log2("n"))
    sizes = sorted(map(tuple, scored.groupBy(band).count().collect()), reverse=True)  # a few hundred bands
    held, least = 0, 1 << 20
    for b, size in sizes:
        held += size
        if held > COMMON_RUNS:
            break
        least = b
    got = scored.where(band >= least).select("code", "score").orderBy("code").toArrow()
    return (got.column("code").to_numpy().astype(np.uint32), got.column("score").to_numpy()), scored.where(band < least)


def log10_common(code: np.ndarray, common: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The scores of common runs; 0 for the others, which are joined."""
    there, at = is_common(code, common)
    out = np.zeros(len(code))
    out[there] = score[at[there]]
    return out


def rare_runs(model):
    """From (id, text): the runs that aren't common, with document and times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = int64_column(batch.column(0))
            for a, _, texts in slices(batch.column(1)):
                code, doc = byte_runs(texts)
                rare = ~is_common(code, model.value[0])[0]
                both, times = np.unique(doc[rare].astype(U64) << U64(32) | code[rare], return_counts=True)
                cols = [ids[a + (both >> U64(32)).astype(np.int64)], (both & U64(0xFFFFFFFF)).astype(np.int64), times]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=["doc", "code", "times"])

    return run


def score_texts(model, common=None, log10=log10_byte):
    """A map from (id, text) to id, words and the model's log10 probability; with the
    counts of common words also what these give: known tokens and sum of log10(c + 0.1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = int64_column(batch.column(0))
            for a, b, texts in slices(batch.column(1)):
                code, doc = byte_runs(texts)
                order = np.argsort(code)
                first, count = runs(code[order])
                each = np.empty(len(code))
                each[order] = np.repeat(log10(code[order[first]], *model.value), count)
                total = np.bincount(doc, weights=each, minlength=len(texts))
                words = texts.words(lower=True)
                cols = [pa.array(ids[a:b]), pa.array(np.diff(words.first)), pa.array(np.diff(texts.off)), pa.array(total)]
                names = ["doc", "words", "bytes", "score"]
                if common is not None:
                    cols += [pa.array(x) for x in weigh_common(words, *common.value)]
                    names += ["known", "load"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


# --- words ------------------------------------------------------------------

SENT = "bucket int, hashes binary, spread binary, docs binary, times binary, ids binary, learns binary"
BACK = pa.schema([("doc", pa.int64()), ("known", pa.int64()), ("load", pa.float64())])
BACK_DDL = "doc bigint, known bigint, load double"
COUNTED = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("times", pa.binary()), ("learnt", pa.binary())])
COUNTED_DDL = "bucket int, hashes binary, times binary, learnt binary"
COUNTS = pa.schema([("hash", pa.int64()), ("times", pa.int64()), ("learnt", pa.int64()), ("kinds", pa.int64())])
COUNTS_DDL = "hash bigint, times bigint, learnt bigint, kinds bigint"


def count_words(buckets: int):
    """Per group of documents and bucket a row: the words of the bucket, each once,
    how often they stand in all and in training documents."""

    def group(parts: list[tuple]) -> pa.RecordBatch:
        h, learns = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(h)
        h = h[order]
        first, times = runs(h)
        h, learnt = h[first], np.add.reduceat(learns[order].astype(np.int64), first)
        bucket = ((h >> U64(32)) % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        h, times, learnt, bucket = h[order], times[order], learnt[order], bucket[order]
        rows = []
        for f, c in zip(*runs(bucket)):
            some = slice(f, f + c)
            rows.append((int(bucket[f]), h[some].tobytes(), squeeze(times[some].astype(np.uint32)), squeeze(learnt[some].astype(np.uint32))))
        return pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), COUNTED)], schema=COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            learns = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for a, _, texts in slices(batch.column(0)):
                words = texts.words(lower=True)
                if len(words):
                    parts.append((words.hash, learns[a + words.doc]))
                    size += len(words)
                if size >= GROUP_WORDS:
                    yield group(parts)
                    parts, size = [], 0
        if parts:
            yield group(parts)

    return run


def add_counts(bucket: pa.Table) -> pa.Table:
    """The bucket's words that may be common, and a row of sums without a hash."""
    cols = [c.to_pylist() for c in bucket.columns[1:]]
    h = np.concatenate([np.frombuffer(x, U64) for x in cols[0]])
    times, learnt = (np.concatenate([unsqueeze(x, np.uint32) for x in c]).astype(np.int64) for c in cols[1:])
    order = np.argsort(h)
    first, _ = runs(h[order])
    times, learnt = np.add.reduceat(times[order], first), np.add.reduceat(learnt[order], first)
    some = np.flatnonzero(times >= COMMON_TIMES)
    hashes = [*h[order[first[some]]].view(np.int64).tolist(), None]
    more = [times[some].tolist() + [int(times.sum())], learnt[some].tolist() + [int(learnt.sum())]]
    kinds = [None] * len(some) + [int(np.count_nonzero(learnt))]
    return pa.table([pa.array(x, pa.int64()) for x in (hashes, *more, kinds)], schema=COUNTS)


def is_common(h: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash is among the sorted common ones, and where."""
    if not len(common):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
    return common[at] == h, at


def weigh_common(words, common: np.ndarray, learnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: known tokens and the sum of log10(c + 0.1) of its common words."""
    n = len(words.texts)
    there, at = is_common(words.hash, common)
    doc, c = words.doc[there], learnt[at[there]] if len(learnt) else np.empty(0)
    return np.bincount(doc[c > 0], minlength=n).astype(np.int64), np.bincount(doc, weights=np.log10(c + 0.1), minlength=n).astype(float)


def send_words(buckets: int, common):
    """Per group of documents and bucket a row: the words of the bucket that aren't
    common, each once, the documents each stands in and how often."""

    def group(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        h, doc, ids, learns = (np.concatenate(x) for x in zip(*parts))
        bucket = ((h >> U64(32)) % U64(buckets)).astype(np.int64)
        order = np.lexsort((doc, h, bucket))
        h, doc, bucket = h[order], doc[order], bucket[order]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]))
        times = np.diff(np.append(first, len(h)))
        h, doc, bucket = h[first], doc[first], bucket[first]
        rows = []
        for f, c in zip(*runs(bucket)):
            some = slice(f, f + c)
            lead, spread = runs(h[some])
            there, local = np.unique(doc[some], return_inverse=True)
            rows.append((
                int(bucket[f]), h[some][lead].tobytes(), squeeze(spread.astype(np.uint32)), squeeze(local.astype(np.uint32)),
                squeeze(times[some].astype(np.uint32)), squeeze(np.diff(ids[there], prepend=0)), squeeze(learns[there].astype(np.uint8)),
            ))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))],
            names=["bucket", "hashes", "spread", "docs", "times", "ids", "learns"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, docs = [], 0, 0
        for batch in batches:
            ids = int64_column(batch.column(0))
            learns = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for a, b, texts in slices(batch.column(1)):
                words = texts.words(lower=True)
                rare = ~is_common(words.hash, common.value[0])[0]
                if not rare.any():
                    continue
                parts.append((words.hash[rare], words.doc[rare] + docs, ids[a:b], learns[a:b]))
                size, docs = size + len(parts[-1][0]), docs + b - a
                if size >= GROUP_WORDS:
                    yield from group(parts)
                    parts, size, docs = [], 0, 0
        if parts:
            yield from group(parts)

    return run


def weigh_words(bucket: pa.Table) -> pa.Table:
    """Counts of the bucket's words over the training documents, and what each
    document gets from them: known tokens and the sum of log10(c + 0.1)."""
    hs, ds, ts, ls = [], [], [], []
    for _, hashes, spread, docs, times, ids, learns in zip(*(c.to_pylist() for c in bucket.columns)):
        local = unsqueeze(docs, np.uint32)
        hs.append(np.repeat(np.frombuffer(hashes, U64), unsqueeze(spread, np.uint32)))
        ds.append(np.cumsum(unsqueeze(ids, np.int64))[local])
        ts.append(unsqueeze(times, np.uint32))
        ls.append(unsqueeze(learns, np.uint8)[local])
    h, doc, times, learns = (np.concatenate(x) for x in (hs, ds, ts, ls))
    del hs, ds, ts, ls
    order = np.argsort(h)
    doc, times, learns = doc[order], times[order].astype(np.int64), learns[order]
    first, size = runs(h[order])
    c = np.add.reduceat(times * learns, first)
    known, load = np.repeat(c > 0, size) * times, np.repeat(np.log10(c + 0.1), size) * times
    order = np.lexsort((load, doc))  # a fixed order of addition
    doc, known, load = doc[order], known[order], load[order]
    first, _ = runs(doc)
    out = [doc[first], np.add.reduceat(known, first), np.add.reduceat(load, first)]
    return pa.table([pa.array(x) for x in out], schema=BACK)


def score_corpus(docs: DataFrame, learns: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per doc_id: whether it was held out, token figures, base score, model score
    and the model's bits per byte.  ``learns`` marks the training rows."""
    spark = docs.sparkSession
    part = docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("doc"), F.col(text).cast("string").alias("text"), learns.alias("learns")
    )
    known_runs, others = common_runs(log10_runs(run_table(part, "text", F.col("learns"))))
    model = spark.sparkContext.broadcast(known_runs)
    size = part.agg(F.sum(F.octet_length("text")), F.sum(F.col("learns").cast("bigint"))).first()
    buckets, ends = int((size[0] or 0) // BUCKET_BYTES) + 12, size[1] or 0
    counted = part.select("text", "learns").mapInArrow(count_words(buckets), COUNTED_DDL)
    counts = step(counted.groupBy("bucket").applyInArrow(add_counts, COUNTS_DDL), "word_counts")
    sums = counts.where("hash IS NULL").agg(F.sum("times"), F.sum("learnt"), F.sum("kinds")).first()
    total, kinds = (sums[1] or 0) + ends, (sums[2] or 0) + (ends > 0)
    often = counts.where(F.col("hash").isNotNull() & (F.col("times") * COMMON_WORDS >= F.lit(sums[0] or 0))).toArrow()
    hashes = often.column("hash").to_numpy().view(U64)
    order = np.argsort(hashes)
    common = spark.sparkContext.broadcast((hashes[order], often.column("learnt").to_numpy()[order]))
    ddl = "doc bigint, words bigint, bytes bigint, score double, known bigint, load double"
    scored = part.select("doc", "text").mapInArrow(score_texts(model, common, log10_common), ddl)
    sent = part.select("doc", "text", "learns").mapInArrow(send_words(buckets, common), SENT)
    back = step(sent.groupBy("bucket").applyInArrow(weigh_words, BACK_DDL), "word_sums")
    by_doc = back.groupBy("doc").agg(F.sum("known").alias("rare_known"), F.sum("load").alias("rare_load"))
    flags = part.groupBy("doc").agg(F.first("learns").alias("learns"), F.count("*").alias("rows"))
    scored = scored.groupBy("doc").agg(*[F.sum(c).alias(c) for c in ("words", "bytes", "score", "known", "load")])
    if not others.isEmpty():
        rare = part.select("doc", "text").mapInArrow(rare_runs(model), "doc bigint, code bigint, times bigint")
        rare = rare.join(others.select("code", F.col("score").alias("each")), "code")
        rare = rare.groupBy("doc").agg(F.sum(F.col("times") * F.col("each")).alias("more"))
        scored = scored.join(rare, "doc", "left").withColumn("score", F.col("score") + F.coalesce("more", F.lit(0.0))).drop("more")
    out = flags.join(scored, "doc", "left").join(by_doc, "doc", "left")
    n_tokens = F.col("words") + F.col("rows")
    scale = math.log10(total + 0.1 * (kinds + 1))
    base = F.col("load") + F.coalesce("rare_load", F.lit(0.0)) + F.col("rows") * math.log10(ends + 0.1) - n_tokens * F.lit(scale)
    return out.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        (~F.col("learns")).alias("held_out"),
        n_tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.when(F.lit(ends > 0), F.col("rows")).otherwise(0)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        (F.col("score") * (-1 / math.log10(2)) / (F.col("bytes") + F.col("rows"))).alias("bits_per_byte"),
    )


@query("op8_context_tree")
def op8_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_corpus(docs, ~held_out(F.col("doc_id"), 10, 0))
