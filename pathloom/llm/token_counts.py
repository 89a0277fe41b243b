"""Tokens of every document by a byte-level vocabulary, counted without encoding most of it.

A byte-level vocabulary cuts a text into pre-tokens by a fixed pattern and encodes each
of them on its own, so a document's count is the sum of the lengths of its pre-tokens.
Lengths come from two tiers, both on the map side:

1. a compact hash table of the frequent pre-tokens, broadcast: 64-bit hashes with open
   addressing and one byte of length each, of at most ``table_size`` entries whatever the
   corpus (1.2 MB for 65,536);
2. for what it misses, a cache in each worker, bounded and started anew when full; what
   the cache lacks too is encoded, every different pre-token of a slice once.

No pre-token is shuffled.  The frequent ones are learnt from ``sample_docs`` documents
chosen by hash; they decide the speed and never the result, since a miss is encoded.
Two pre-tokens share a hash with odds of (pre-tokens in tables) x (pre-tokens) / 2^64.

Long texts are cut where a pre-token must begin (a blank between two visible ASCII
characters), so that memory follows the slice and not the longest text.

Defined results: a null text is empty and has no bytes and no tokens; a null or repeated
doc_id is kept, each row is counted by itself; other columns are ignored unless named in
``keep``.  Strings that the vocabulary lists as added tokens are one token wherever they
stand, as its library has it.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import query, table
from pathloom.llm.packing import character_classes, piece_starts
from pathloom.llm.textcols import BYTE_BASE, SLICE_BYTES, U64, Texts, slices, span_hashes

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TABLE_SIZE = 1 << 16
SAMPLE_DOCS = 20_000
#: Tasks that look at the sample; each sends at most a table to the driver.
SAMPLE_TASKS = 8
#: Lengths a worker keeps besides the table.
CACHE_SIZE = 1 << 18


class LengthTable:
    """Length by 64-bit hash, as open addressing with linear steps, at most half full."""

    def __init__(self, keys: np.ndarray, lengths: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys, self.lengths = np.zeros(1 << self.bits, U64), np.zeros(1 << self.bits, np.uint8)
        at = self.home(keys)
        todo = np.flatnonzero(keys != 0)  # zero marks an empty slot
        while len(todo):
            free = todo[self.keys[at[todo]] == 0]
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.keys[at[put]], self.lengths[at[put]] = keys[put], lengths[put]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)

    def home(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> U64(64 - self.bits)).astype(np.int64)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """The length of each key, 0 where the table lacks it."""
        at = self.home(keys)
        out = np.zeros(len(keys), np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            here = self.keys[at[todo]]
            hit = here == keys[todo]
            out[todo[hit]] = self.lengths[at[todo[hit]]]
            todo = todo[~hit & (here != 0)]
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
        return out


class Vocabulary:
    """The encoder of pre-tokens and the added tokens of a byte-level vocabulary."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        if any(x[k] for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens that depend on their surroundings")
        added = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.blank_inside = any(" " in x for x in added)
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.kinds = character_classes()

    def lengths(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.model.encode_batch(pieces, add_special_tokens=False)]

    def added_spans(self, text: str, off: np.ndarray) -> list[tuple[int, int]]:
        """Where added tokens stand, none across the border of two documents."""
        spans = []
        hit = self.added.search(text)
        while hit:
            i = int(np.searchsorted(off, hit.start(), "right")) - 1
            s, e = int(off[i]), int(off[i + 1])
            spans += [(s + m.start(), s + m.end()) for m in self.added.finditer(text[s:e])]
            hit = self.added.search(text, e)
        return spans


class Pieces:
    """The pre-tokens of a slice: ``start`` and ``end`` in ``text``, ``doc`` the index of
    their document, ``hash`` one number each; ``added`` marks the added tokens."""

    def __init__(self, texts: Texts, vocabulary: Vocabulary):
        self.text = texts.buf.tobytes().decode("utf-8")
        codes = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        off = np.concatenate([[0], np.cumsum((texts.buf & 0xC0) != 0x80)])[texts.off]
        spans = np.array(vocabulary.added_spans(self.text, off), np.int64).reshape(-1, 2)
        if len(codes):
            self.start = piece_starts(codes, vocabulary.kinds[codes], np.union1d(off, spans))
            if len(spans):  # an added token is one piece
                last = spans[np.maximum(np.searchsorted(spans[:, 0], self.start, "right") - 1, 0)]
                self.start = self.start[(self.start <= last[:, 0]) | (self.start >= last[:, 1])]
        else:
            self.start = np.empty(0, np.int64)
        self.end = np.append(self.start[1:], len(codes))[: len(self.start)]
        self.added = np.isin(self.start, spans[:, 0])
        code = codes.astype(U64) * BYTE_BASE
        code ^= code >> U64(29)
        self.hash = span_hashes(code, self.start, self.end)
        self.doc = np.searchsorted(off, self.start, "right") - 1

    def strings(self, which: np.ndarray) -> list[str]:
        return [self.text[s:e] for s, e in zip(self.start[which].tolist(), self.end[which].tolist())]


def cut_long(texts: Texts, blank_inside: bool = False, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The text of one long document in parts, cut before a blank between two visible
    ASCII characters, where a pre-token begins whatever stands around."""
    buf, at = texts.buf, 0
    visible = np.zeros(256, bool)
    visible[33:127] = True
    while len(buf) - at > limit and not blank_inside:
        stop = at + limit
        while True:
            look = buf[at + 1 : min(stop, len(buf) - 1)]
            good = np.flatnonzero((look[1:-1] == 32) & visible[look[:-2]] & visible[look[2:]])
            if len(good) or stop >= len(buf):
                break
            stop += limit
        if not len(good):
            break
        to = at + 2 + int(good[-1])
        yield Texts(buf[at:to], np.array([0, to - at]))
        at = to
    yield Texts(buf[at:], np.array([0, len(buf) - at]))


def parts(column: pa.Array, vocabulary: Vocabulary) -> Iterator[tuple[int, int, Pieces]]:
    """First row, one past the last row, and pre-tokens of each slice of a column."""
    for a, b, texts in slices(column):
        whole = b - a > 1 or len(texts.buf) <= SLICE_BYTES
        for part in (texts,) if whole else cut_long(texts, vocabulary.blank_inside):
            yield a, b, Pieces(part, vocabulary)


def summarise(path: str, most: int) -> Callable:
    """Each task's most frequent pre-tokens: hashes, counts and lengths, as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = Vocabulary(path), {}
        keys, counts = np.empty(0, U64), np.empty(0, np.int64)
        for batch in batches:
            for _, _, p in parts(batch.column(0), vocabulary):
                h, first, n = np.unique(p.hash[~p.added], return_index=True, return_counts=True)
                plain = np.flatnonzero(~p.added)
                new = [i for i, x in enumerate(h.tolist()) if x not in known]
                known.update(zip(h[new].tolist(), vocabulary.lengths(p.strings(plain[first[new]]))))
                keys, back = np.unique(np.concatenate([keys, h]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([counts, n]), len(keys)).astype(np.int64)
        top = np.lexsort([keys, -counts])[:most]
        lengths = np.fromiter((known[k] for k in keys[top].tolist()), np.int64, len(top))
        top, lengths = top[lengths < 256], lengths[lengths < 256]
        row = [[x.tobytes()] for x in (keys[top], counts[top], lengths.astype(np.uint8))]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in row], names=["keys", "counts", "lengths"])

    return run


def frequent_lengths(docs: DataFrame, doc_id: str, text: str, vocabulary: str = VOCABULARY, table_size: int = TABLE_SIZE, sample_docs: int = SAMPLE_DOCS) -> LengthTable:
    """The lengths of the pre-tokens that are most frequent in a sample of the documents."""
    rows, span = docs.count(), 1 << 40
    chosen = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(span)) < int(span * min(1, sample_docs / max(rows, 1)))
    part = docs.where(chosen).select(F.col(text).cast("string"))
    found = part.repartition(SAMPLE_TASKS).mapInArrow(summarise(vocabulary, table_size), "keys binary, counts binary, lengths binary").collect()

    def column(name: str, dtype: type) -> np.ndarray:
        return np.frombuffer(b"".join(bytes(r[name]) for r in found), dtype)

    keys, first, back = np.unique(column("keys", U64), return_index=True, return_inverse=True)
    counts = np.bincount(back, column("counts", np.int64), len(keys))
    lengths = column("lengths", np.uint8)[first]
    top = np.lexsort([keys, -counts])[:table_size]
    return LengthTable(keys[top], lengths[top])


class Lengths:
    """Both tiers: the table, then the worker's cache, then the encoder."""

    def __init__(self, frequent: LengthTable, vocabulary: Vocabulary, cache_size: int = CACHE_SIZE):
        self.frequent, self.vocabulary, self.most = frequent, vocabulary, cache_size
        self.cache: dict[int, int] = {}

    def __call__(self, p: Pieces) -> np.ndarray:
        out = self.frequent.lookup(p.hash)
        out[p.added] = 1
        missed = np.flatnonzero(out == 0)
        if len(missed):
            h, first, back = np.unique(p.hash[missed], return_index=True, return_inverse=True)
            keys = h.tolist()
            new = np.array([i for i, k in enumerate(keys) if k not in self.cache], np.int64)
            if len(new) + len(self.cache) > self.most:
                self.cache.clear()
                new = np.arange(len(keys))
            got = self.vocabulary.lengths(p.strings(missed[first[new]])) if len(new) else []
            self.cache.update(zip(h[new].tolist(), got))
            out[missed] = np.fromiter((self.cache[k] for k in keys), np.int64, len(keys))[back]
        return out


def count_with(frequent, path: str, cache_size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        lengths = Lengths(frequent.value, vocabulary, cache_size)
        for batch in batches:
            n_tokens = np.zeros(batch.num_rows, np.int64)
            for a, b, p in parts(batch.column(0), vocabulary):
                n_tokens[a:b] += np.bincount(p.doc, lengths(p), b - a).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(n_tokens)], names=[*batch.schema.names[1:], "_n"])

    return run


def token_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    limit: int = 512,
    keep: list[str] | None = None,
    table_size: int = TABLE_SIZE,
    sample_docs: int = SAMPLE_DOCS,
    cache_size: int = CACHE_SIZE,
) -> DataFrame:
    """A row per document: ``n_bytes``, ``n_tokens``, and whether it has more than
    ``limit`` tokens; before them ``doc_id`` or the columns named in ``keep``."""
    spark = docs.sparkSession
    kept = [doc_id] if keep is None else keep
    frequent = spark.sparkContext.broadcast(frequent_lengths(docs, doc_id, text, vocabulary, table_size, sample_docs))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    part = docs.select(body.alias("_t"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(kept)], F.octet_length(body).cast("bigint").alias("_b"))
    fields = [f"_k{i} {part.schema[i + 1].dataType.simpleString()}" for i in range(len(kept))]
    found = part.mapInArrow(count_with(frequent, vocabulary, cache_size), ", ".join([*fields, "_b bigint", "_n bigint"]))
    names = [F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)]
    return found.select(*names, F.col("_b").alias("n_bytes"), F.col("_n").alias("n_tokens"), (F.col("_n") > limit).alias("over_limit"))


@query("op11_token_counts")
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).withColumn("doc_id", F.col("doc_id").cast("bigint"))
