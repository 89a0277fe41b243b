"""Removal of passages that repeat, by hashes of all fixed-length word windows.

Every window of ``n`` consecutive words gets a Rabin-Karp hash.  Windows that
occur again lie in one hash bucket; there the earliest place (least doc_id, then
least start) stays and every later one is marked.  Marked windows merge into
maximal intervals of words to take out.

One pass over the text, one shuffle of about ten bytes a window.  Within a group
of windows each hash is sent once, with its earliest place, so a passage that
stands in a third of all documents sends one entry per group, not one per copy.  Places
that are known to repeat within their group are dealt over all buckets, ``PLACES`` at a
time, so that no bucket gets more of them than the others.  Buckets are cut by hash;
their number follows the bytes of text, so a bucket keeps its size at any scale.  Two different windows share a 64-bit hash
with odds of about windows squared / 2**65.

Defined results: a null text has no words; a row without a doc_id is a document of its
own, before all ids (numbers below -2**62 are kept for such rows), in an order given by
its text; rows that share a doc_id, or have none and the same text, are one document
for the order, and what is marked for it is taken out of each of its rows; the same
window at the same start of such rows is no repeat.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import query, step, table
from pathloom.llm.textcols import NO_ID, U64, ids_back, int64_column, mix, ragged, slices

#: Text bytes per hash bucket: some million windows.
BUCKET_BYTES = 7 << 20
LEAST_BUCKETS = 64
#: Windows sorted at once on the sending side.
GROUP_WINDOWS = 1 << 20
#: Known repeats sent together.
PLACES = 1 << 13


def squeeze(a: np.ndarray) -> bytes:
    """Numbers by byte plane, compressed; small numbers cost little."""
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def unsqueeze(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of equal neighbours."""
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.empty(0, np.int64)
    return first, np.diff(np.append(first, len(a)))


def pack_places(doc: np.ndarray, start: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Places in order of (doc, start) as three compressed lists."""
    first, count = runs(doc)
    step_ = np.diff(start, prepend=0)
    step_[first] = start[first]
    ids = np.diff(doc[first], prepend=0)  # wraps round for far ids; the sum wraps back
    return squeeze(ids.astype(np.int64)), squeeze(count.astype(np.uint32)), squeeze(step_.astype(np.uint32))


def unpack_places(ids: bytes, counts: bytes, steps: bytes) -> tuple[np.ndarray, np.ndarray]:
    doc = np.cumsum(unsqueeze(ids, np.int64))
    count = unsqueeze(counts, np.uint32).astype(np.int64)
    total = np.cumsum(unsqueeze(steps, np.uint32).astype(np.int64))
    first = np.cumsum(count) - count
    base = np.concatenate([[0], total])[first]
    return np.repeat(doc, count), total - np.repeat(base, count)


WINDOWS = pa.schema(
    [("bucket", pa.int32()), ("hashes", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary()), ("steps", pa.binary())]
)
WINDOWS_DDL = "bucket int, hashes binary, ids binary, counts binary, steps binary"
MARKS = pa.schema([("doc", pa.int64()), ("starts", pa.binary())])
MARKS_DDL = "doc bigint, starts binary"


def batch_windows(batch: pa.RecordBatch, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hash, document and start of every window, in order of (document, start),
    about GROUP_WINDOWS at a time."""
    ids = int64_column(batch.column(0))
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    out, size = [], 0
    for a, b, texts in slices(batch.column(1).take(pa.array(order))):
        words = texts.words()
        h, at = words.windows(n)
        doc = words.doc[at]
        out.append((h, ids[a + doc], (at - words.first[doc]).astype(np.int64)))
        size += len(h)
        if size >= GROUP_WINDOWS or b == len(ids):
            h, doc, start = (np.concatenate(x) for x in zip(*out))
            if len(ids) > 1 and (ids[1:] == ids[:-1]).any():  # rows that share an id
                order = np.lexsort((start, doc))
                h, doc, start = h[order], doc[order], start[order]
            out, size = [], 0
            if len(h):
                yield h, doc, start


def send_windows(n: int, buckets: int):
    """Per batch and bucket a row with each hash once; more rows, without hashes,
    for places already known to be repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, doc, start in (group for batch in batches for group in batch_windows(batch, n)):
            order = np.argsort(h)
            first, count = runs(h[order])
            lead = np.minimum.reduceat(order, first)
            again = np.ones(len(h), bool)
            again[lead] = False
            of = np.empty(len(h), np.int64)
            of[order] = np.repeat(lead, count)
            again &= (doc != doc[of]) | (start != start[of])
            del order, of
            lead.sort()
            bucket = ((h[lead] >> U64(32)) % U64(buckets)).astype(np.uint16 if buckets <= 65536 else np.uint32)
            by = np.argsort(bucket, kind="stable")
            lead, bucket = lead[by], bucket[by]
            rows = []
            for f, c in zip(*runs(bucket)):
                take = lead[f : f + c]
                rows.append((int(bucket[f]), h[take].tobytes(), *pack_places(doc[take], start[take])))
                if len(rows) == 1024:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), WINDOWS)], schema=WINDOWS)
                    rows = []
            doc, start = doc[again], start[again]
            for f in range(0, len(doc), PLACES):
                some = slice(f, f + PLACES)
                deal = mix(doc[f : f + 1].view(U64) ^ mix(start[f : f + 1].view(U64)))[0]
                rows.append((int(deal % U64(buckets)), None, *pack_places(doc[some], start[some])))
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), WINDOWS)], schema=WINDOWS)

    return run


def later_places(bucket: pa.Table) -> pa.Table:
    """Of one bucket: the places whose window has an earlier place."""
    hs, ds, ss, marked = [], [], [], []
    for _, hashes, ids, counts, steps in zip(*(c.to_pylist() for c in bucket.columns)):
        doc, start = unpack_places(ids, counts, steps)
        if hashes is None:
            marked.append((doc, start))
        else:
            hs.append(np.frombuffer(hashes, U64))
            ds.append(doc)
            ss.append(start.astype(np.uint32))
    if hs:
        h, doc, start = np.concatenate(hs), np.concatenate(ds), np.concatenate(ss)
        del hs, ds, ss
        order = np.argsort(h)
        first, count = runs(h[order])
        twice = order[np.repeat(count > 1, count)]
        twice = twice[np.lexsort((start[twice], doc[twice], h[twice]))]
        h, doc, start = h[twice], doc[twice], start[twice]
        first, count = runs(h)
        lead = np.repeat(first, count)
        again = (doc != doc[lead]) | (start != start[lead])
        marked.append((doc[again], start[again].astype(np.int64)))
    doc, start = (np.concatenate(x) for x in zip(*marked))
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order].astype(np.uint32)
    first, count = runs(doc)
    data = start.tobytes()
    blobs = [data[4 * f : 4 * (f + c)] for f, c in zip(first.tolist(), count.tolist())]
    return pa.table([pa.array(doc[first], pa.int64()), pa.array(blobs, pa.binary())], schema=MARKS)


def bucket_count(docs: DataFrame, text: str) -> int:
    """Enough buckets to spread a small input, and more as the bytes of text grow."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return int(size // BUCKET_BYTES) + LEAST_BUCKETS


def document_number(doc_id: str, text: str) -> Column:
    """The id; for a row without one a number below all ids, made from its text."""
    own = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).bitwiseAND(F.lit((1 << 61) - 1))
    return F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID) + own)


def later_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 20) -> DataFrame:
    """Starts of windows that also start earlier: doc (see :func:`document_number`),
    starts (unsigned 32-bit numbers); a document may have several rows."""
    part = docs.select(document_number(doc_id, text), F.col(text).cast("string"))
    sent = part.mapInArrow(send_windows(n, bucket_count(docs, text)), WINDOWS_DDL)
    return sent.groupBy("bucket").applyInArrow(later_places, MARKS_DDL)


def cover(words, marks: list[list[bytes] | None], n: int) -> np.ndarray:
    """True for each word of the slice that lies in a marked window."""
    change = np.zeros(len(words) + 1, np.int64)
    for i, found in enumerate(marks):
        if found:
            size = words.first[i + 1] - words.first[i]
            at = np.frombuffer(b"".join(found), np.uint32).astype(np.int64)
            at = np.unique(at[at <= size - n]) + words.first[i]
            change[at] += 1
            change[at + n] -= 1
    return np.cumsum(change[:-1]) > 0


def joined_words(words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each document, one space between: bytes and borders."""
    start, end, doc = words.start[keep], words.end[keep], words.doc[keep]
    size = end - start + 1
    out = np.append(words.texts.buf, np.uint8(32))[ragged(start, size)]
    out[np.cumsum(size) - 1] = 32
    border = np.zeros(len(words.texts) + 1, np.int64)
    np.cumsum(np.bincount(doc, weights=size, minlength=len(words.texts)).astype(np.int64), out=border[1:])
    return out, border


def cut_out(n: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = ids_back(int64_column(batch.column(0)))
            marks = batch.column(2).to_pylist()
            for a, b, texts in slices(batch.column(1)):
                words = texts.words()
                gone = cover(words, marks[a:b], n)
                out, border = joined_words(words, ~gone)
                whole = out.tobytes()
                kept = [whole[s : max(s, e - 1)] for s, e in zip(border[:-1].tolist(), border[1:].tolist())]
                n_gone = np.bincount(words.doc[gone], minlength=len(texts))
                step_ = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                opens, ends = np.flatnonzero(step_ == 1), np.flatnonzero(step_ == -1)
                # an interval never runs from one document into the next
                cuts = words.first[1:-1]
                cuts = np.unique(cuts[(cuts > 0) & (cuts < len(words))])
                cuts = cuts[gone[cuts] & gone[cuts - 1]]
                opens, ends = np.sort(np.append(opens, cuts)), np.sort(np.append(ends, cuts))
                cols = [ids[a:b], pa.array(np.diff(words.first)), pa.array(n_gone.astype(np.int64))]
                cols.append(pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()))
                if with_text:
                    cols.append(pa.array([x.decode() for x in kept], pa.string()))
                    doc = words.doc[opens] if len(opens) else opens
                    where = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
                    pairs = pa.StructArray.from_arrays(
                        [pa.array(opens - words.first[doc]), pa.array(ends - words.first[doc])], names=["start", "end"]
                    )
                    cols.append(pa.ListArray.from_arrays(pa.array(where), pairs))
                yield pa.RecordBatch.from_arrays(cols, names=[str(i) for i in range(len(cols))])

    return run


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 20, with_text: bool = True
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 of the words that stay; with
    ``with_text`` also those words (one space between) and the removed intervals
    of word positions."""
    marks = step(later_windows(docs, doc_id, text, n), "later_windows")
    marks = marks.groupBy("doc").agg(F.collect_list("starts").alias("marks"))
    part = docs.select(document_number(doc_id, text).alias("doc"), F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    both = part.join(marks.hint("shuffle_hash"), "doc", "left").select("id", "text", "marks")
    ddl = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    if with_text:
        ddl += ", kept string, removed array<struct<start:bigint,end:bigint>>"
    return both.mapInArrow(cut_out(n, with_text), ddl)


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS i FROM w
), g AS (
  SELECT doc_id, i, hash(array_to_string(ws[i:i + 19], ' ')) AS h, sha256(array_to_string(ws[i:i + 19], ' ')) AS k FROM s
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h, k ORDER BY doc_id, i) AS r FROM g) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w
), kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS t, count(*) AS n
  FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


@query("op1_substring_dedup", SQL)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
