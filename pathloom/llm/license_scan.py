"""Short licence notices in texts, allowing a few edits.

A text is brought to lower-case words with one space between.  A notice that may
differ by k edits is cut into k + 1 seeds; at least one seed then stands unchanged
in any match (pigeonhole), so an automaton over all seeds finds every candidate
place.  There the regex library matches the whole notice with at most k errors and
reports the span and the edits.  Exact places of the base phrases come from the same
words.

One pass, no shuffle; whole texts of any length, no cap on places.

Defined results: a null or empty text has no words, no labels and score 0; each row
is searched alone; a null doc_id stays null; other columns may be kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import query, table, unused

#: Base phrases and their labels (fixed values).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Notices searched with edits, and their labels (public licence wordings).
NOTICES = {
    "under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license version 2": "apache-2",
    "licensed under the apache license": "apache-2",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons zero": "cc0",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "reserved",
}

#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12

#: Lower case, and a space for all that is no ASCII letter, digit or byte of a far character.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain_words(text: str) -> str:
    """The words of a text, in lower case, with one space between."""
    return b" ".join(text.encode().translate(FOLD).split()).decode()


def exact_places(words: str, phrases: dict[str, str]) -> list[tuple[int, str]]:
    """Number of the first word, and label, of every place of every phrase."""
    padded, out = f" {words} ", []
    for phrase, label in phrases.items():
        wanted, at = f" {phrase} ", padded.find(f" {phrase} ")
        count, done = 0, 0
        while at >= 0:
            count, done = count + padded.count(" ", done, at), at
            out.append((count, label))
            at = padded.find(wanted, at + 1)
    return out


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """Offsets and texts of the parts of a notice, one more than the edits."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Search:
    """Bounded-error search for all notices at once."""

    def __init__(self, notices: dict[str, str], chars_per_edit: int = CHARS_PER_EDIT):
        import ahocorasick
        import regex

        self.notices = [(notice, label, len(notice) // chars_per_edit) for notice, label in notices.items()]
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={k}}}") for n, _, k in self.notices]
        by_seed: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _, edits) in enumerate(self.notices):
            for offset, seed in seeds(notice, edits):
                by_seed.setdefault(seed, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in by_seed.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()

    def spans(self, words: str) -> list[tuple[int, int, str, int, int]]:
        """Start, end, label, edits and notice length of each match, by place."""
        places: dict[int, list[int]] = {}
        for end, (size, uses) in self.automaton.iter(words):
            for i, offset in uses:
                places.setdefault(i, []).append(end + 1 - size - offset)
        out = []
        for i, starts in places.items():
            notice, label, edits = self.notices[i]
            done = -1
            for start in sorted(starts):
                a, b = max(0, start - edits), start + len(notice) + edits
                if a < done:
                    a = done  # what lies before is part of a match already
                m = self.patterns[i].search(words, a, min(b, len(words))) if a < b else None
                if m:
                    out.append((m.start(), m.end(), label, sum(m.fuzzy_counts), len(notice)))
                    done = m.end()
        return sorted(out)


SPANS = "array<struct<label:string,first_word:bigint,last_word:bigint,edits:int>>"
OUT = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
SPAN_TYPE = pa.list_(
    pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())])
)


def scan(notices: dict[str, str], base: dict[str, str], chars_per_edit: int, with_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(notices, chars_per_edit)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), SPAN_TYPE]
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                words = plain_words(text or "")
                exact = exact_places(words, base)
                found = search.spans(words)
                starts, names = [at for at, _ in exact], sorted({label for _, label in exact})
                labels = sorted({*names, *(x[2] for x in found)})
                score = 1.0 if exact else max((1 - edits / size for *_, edits, size in found), default=0.0)
                spans = [
                    {"label": label, "first_word": words.count(" ", 0, s + 1), "last_word": words.count(" ", 0, e - 1), "edits": edits}
                    for s, e, label, edits, _ in found
                ] if with_spans else None
                n_words = words.count(" ") + 1 if words else 0
                rows.append(
                    (n_words, len(exact), min(starts, default=None), max(starts, default=None), ",".join(names), ",".join(labels), score, spans)
                )
            made = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            cols = [batch.column(i) for i in range(1, batch.num_columns)] + made[: 8 if with_spans else 7]
            yield pa.RecordBatch.from_arrays(cols, names=[str(i) for i in range(len(cols))])

    return run


def scan_licences(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    notices: dict[str, str] = NOTICES,
    base: dict[str, str] = BASE,
    chars_per_edit: int = CHARS_PER_EDIT,
    with_spans: bool = True,
) -> DataFrame:
    """The columns ``keep`` (all by default), the figures, the labels and with
    ``with_spans`` the matches by word numbers and edits."""
    ddl = OUT + f", spans {SPANS}" * with_spans
    made = [x.split()[0] for x in OUT.split(", ")] + ["spans"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    part = docs.select(F.col(text).cast("string").alias(unused(docs, "_text")), *keep)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in part.schema.fields[1:])
    return part.mapInArrow(scan(notices, base, chars_per_edit, with_spans), kept + ddl)


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"), keep=["doc_id"], with_spans=False)
