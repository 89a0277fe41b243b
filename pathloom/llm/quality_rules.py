"""Quality rules on text shape and on tokeniser fertility.

Plain rules count words, symbols, repeated lines and repeated word windows.  The
fertility rules read a text through public vocabularies: characters per token,
the share of tokens that are raw bytes (a vocabulary falls back to them for what
it has never seen) and the entropy of the token distribution.  Ordinary prose of
a script lies in a band of each; text outside is rejected.

One pass, no shuffle; a document is judged alone.

Defined results: a null or empty text has no words and fails the base rules; the
script of a text without letters is "none", which has the widest bands; other
columns stay as they are, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import query, table, unused
from pathloom.llm.textcols import IS_SPACE, U64, WORD_BASE, Texts, mix, ragged, slices, span_hashes
from pathloom.llm.wordpieces import PieceStore, sentencepiece_encoder, tiktoken_encoder

REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30


class Band(NamedTuple):
    """What prose of one script shows; the limits are kept."""

    least_chars: float  # characters per token, piece vocabulary
    most_chars: float
    least_byte_chars: float  # characters per token, byte-level vocabulary
    most_fallback: float  # share of raw-byte tokens
    least_entropy: float  # bits per token, asked of texts of ENTROPY_TOKENS or more


ENTROPY_TOKENS = 64
#: Bands by script.  Scripts that the vocabularies know little of need more tokens a character.
BANDS = {
    "latin": Band(1.2, 8.0, 1.2, 0.10, 3.5),
    "greek": Band(0.7, 6.0, 0.4, 0.25, 3.0),
    "cyrillic": Band(0.8, 6.0, 0.4, 0.25, 3.0),
    "semitic": Band(0.6, 6.0, 0.4, 0.40, 3.0),
    "indic": Band(0.3, 6.0, 0.2, 0.95, 2.5),
    "cjk": Band(0.3, 4.0, 0.2, 0.95, 3.0),
    "none": Band(0.2, 20.0, 0.1, 1.0, 0.0),
}
SCRIPTS = list(BANDS)


def script_codes() -> np.ndarray:
    """Script of a character by the first byte of its UTF-8 form."""
    of = np.full(256, SCRIPTS.index("none"), np.uint8)
    for name, spans in {
        "latin": [(65, 91), (97, 123), (0xC3, 0xCA)],
        "greek": [(0xCD, 0xD0)],
        "cyrillic": [(0xD0, 0xD5)],
        "semitic": [(0xD6, 0xDD)],
        "indic": [(0xE0, 0xE1)],
        "cjk": [(0xE3, 0xEE)],
    }.items():
        for a, b in spans:
            of[a:b] = SCRIPTS.index(name)
    return of


SCRIPT_OF = script_codes()
IS_SYMBOL = np.zeros(256, np.int64)
IS_SYMBOL[list(b"#*$%&|<>")] = 1


def per_doc(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of values between the borders."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def in_doc(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Keys that differ between documents."""
    return mix(keys + mix(doc.astype(U64) + U64(1)) * WORD_BASE)


def repeated_lines(texts: Texts, words) -> np.ndarray:
    buf, off = texts.buf, texts.off
    breaks = np.flatnonzero(buf == 10)
    starts = np.sort(np.append(off[:-1], breaks + 1))
    ends = np.sort(np.append(off[1:], breaks))
    full = np.searchsorted(words.start, ends) > np.searchsorted(words.start, starts)
    starts, ends = starts[full], ends[full]
    doc = words.doc[np.searchsorted(words.start, starts)]
    keys = in_doc(span_hashes(BYTES[buf], starts, ends), doc)
    _, lead = np.unique(keys, return_index=True)
    n = len(texts)
    return np.bincount(doc, minlength=n) - np.bincount(doc[lead], minlength=n)


BYTES = mix(np.arange(3, 259, dtype=U64))


def repeated_words(words, n: int) -> np.ndarray:
    """Words in n-word windows found twice or more in their document."""
    h, at = words.windows(n)
    if not len(h):
        return np.zeros(len(words.texts), np.int64)
    keys = in_doc(h, words.doc[at])
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    at = at[order[twice]]
    change = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + n, minlength=len(words) + 1)
    return np.bincount(words.doc[np.cumsum(change[:-1]) > 0], minlength=len(words.texts)).astype(np.int64)


class Fertility:
    """Token figures of a slice by two vocabularies."""

    def __init__(self, pieces: str, ranks: str):
        encode, self.is_byte = sentencepiece_encoder(pieces)
        self.pieces, self.bytes = PieceStore(encode), PieceStore(tiktoken_encoder(ranks))

    def __call__(self, words) -> dict[str, np.ndarray]:
        texts, n = words.texts, len(words.texts)
        keys, lead, back = np.unique(words.hash, return_index=True, return_inverse=True)
        data = texts.buf.tobytes()

        def text_of(some, space=""):
            at = lead[some]
            return [space + data[s:e].decode("utf-8", "replace") for s, e in zip(words.start[at].tolist(), words.end[at].tolist())]

        first, count = self.pieces.lookup(keys, text_of)
        raw = np.concatenate([[0], np.cumsum(self.is_byte[self.pieces.ids])])
        raw = raw[first + count] - raw[first]
        n_tokens = np.bincount(words.doc, weights=count[back], minlength=n)
        n_raw = np.bincount(words.doc, weights=raw[back], minlength=n)
        ids = self.pieces.ids[ragged(first[back], count[back])].astype(np.int64)
        ids += np.repeat(words.doc, count[back]) * len(self.is_byte)
        ids.sort()
        lead_ = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.empty(0, np.int64)
        times = np.diff(np.append(lead_, len(ids))).astype(float)
        load = np.bincount(ids[lead_] // len(self.is_byte), weights=times * np.log2(times), minlength=n)
        some = np.maximum(n_tokens, 1)
        _, count_b = self.bytes.lookup(keys, lambda k: text_of(k, " "))
        return {
            "n_tokens": n_tokens,
            "n_byte_level": np.bincount(words.doc, weights=count_b[back], minlength=n),
            "fallback": n_raw / some,
            "entropy": np.where(n_tokens > 0, np.log2(some) - load / some, 0.0),
        }


OUT = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, script string, chars_per_token double, chars_per_byte_token double, fallback_share double, token_entropy double"


def judge(texts: Texts, fertility: Fertility, bands: np.ndarray) -> list[np.ndarray]:
    words, n = texts.words(), len(texts)
    in_word = ~IS_SPACE[texts.buf]
    n_words = np.diff(words.first)
    chars = per_doc(in_word & ((texts.buf & 0xC0) != 0x80), texts.off)
    repeated = repeated_words(words, REPEAT_WINDOW)
    failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n_words)
    got = fertility(words)
    code = SCRIPT_OF[texts.buf]
    votes = np.stack([per_doc(code == k, texts.off) for k in range(len(SCRIPTS) - 1)])
    script = np.where(votes.max(axis=0) > 0, votes.argmax(axis=0), len(SCRIPTS) - 1)
    per_token = chars / np.maximum(got["n_tokens"], 1)
    per_byte_token = chars / np.maximum(got["n_byte_level"], 1)
    b = bands[script].T
    inside = (per_token >= b[0]) & (per_token <= b[1]) & (per_byte_token >= b[2]) & (got["fallback"] <= b[3])
    inside &= (got["entropy"] >= b[4]) | (got["n_tokens"] < ENTROPY_TOKENS)
    return [
        n_words, chars, per_doc(IS_SYMBOL[texts.buf], texts.off), repeated_lines(texts, words), repeated, failed,
        inside & ~failed, np.array(SCRIPTS)[script], per_token, per_byte_token, got["fallback"], got["entropy"],
    ]


def rules(pieces: str, ranks: str, bands: dict[str, Band]):
    limits = np.array([bands[s] for s in SCRIPTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = Fertility(pieces, ranks)
        for batch in batches:
            for a, b, texts in slices(batch.column(0)):
                cols = [pa.array(x) for x in judge(texts, fertility, limits)]
                rest = [batch.column(i)[a:b] for i in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays(rest + cols, names=[str(i) for i in range(len(rest) + len(cols))])

    return run


def quality_report(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    pieces: str = public_tokenizers.path("piece_bpe_32k.model"),
    ranks: str = public_tokenizers.path("byte_bpe_50k.tiktoken"),
    bands: dict[str, Band] = BANDS,
) -> DataFrame:
    """The columns ``keep`` (all by default) and the figures and verdict of each row."""
    made = [x.split()[0] for x in OUT.split(", ")]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    part = docs.select(F.col(text).cast("string").alias(unused(docs, "_text")), *keep)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in part.schema.fields[1:])
    return part.mapInArrow(rules(pieces, ranks, bands), f"{kept}, {OUT}" if kept else OUT)


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), keep=["doc_id"])
