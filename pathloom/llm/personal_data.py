"""Personal data: rule spans, and more spans picked by boosted trees.

Rule spans (e-mail, IP, card, phone) are the leftmost matches of fixed patterns
that pass a check.  Generators of high recall propose further spans, which may
overlap: the rule patterns' failures, numbers in groups, masked addresses, account
numbers, long hexadecimal keys.  Boosted trees score a proposal by its form and by
the words before it; what passes the threshold of its kind and overlaps nothing
better is added.

The trees learn from proposals that a check can settle (a checksum, a number
range): those that pass against those that fail.  For kinds that no check settles they
learn from fixed examples (:data:`EXAMPLES`), which are part of every fit, so that a
table of one row and a large one are judged alike.  All settled proposals of all texts
are used: two thirds, told apart by a checksum of their text, for the fit, and the rest
for the thresholds per kind.  Their forms are counted by Spark; cuts, each level of a tree
and thresholds come from sums over that table, of which the driver gets bounded numbers
only.  Two passes over the texts, no shuffle of text; every pattern is linear in the text.

Defined results: a null text is empty and has no spans; each row is searched alone;
a null doc_id stays null; proposals that pass a check of their own are always taken;
offsets count code points, the end exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import query, step, table, unused
from pathloom.llm.boosting import BoostedTrees, pack, unpack

#: Different binned forms per task of the fit.
ROWS = 2**17
#: Steps of a score, as thresholds see it.
STEPS = 2**12
#: Share of settled proposals above a threshold that must have passed their check.
PRECISION = 0.98
KINDS = ("email", "ip", "card", "phone", "account", "id_number", "key")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[@0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

#: Proposals beyond the rule patterns.
MORE = (
    ("phone", re.compile(r"(?<![0-9A-Za-z.+(])\(?[0-9]{2,5}\)?(?:[ ./-][0-9]{2,5}){1,4}(?![0-9A-Za-z])")),
    ("account", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")),
    ("id_number", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("ip", re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    ("key", re.compile(r"(?<![0-9A-Za-z])[0-9A-Za-z_-]{24,}+(?![0-9A-Za-z_-])")),
)
MASKED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}){1,6}")

#: Words that, standing before a span, tell what it is.
CUES = {
    "mail": ("mail", "contact", "write", "@"), "call": ("phone", "tel", "call", "fax", "mobile", "dial"),
    "pay": ("card", "visa", "account", "iban", "pay", "bank"), "net": ("ip", "server", "host", "address"),
    "secret": ("key", "token", "secret", "password", "pwd"), "count": ("version", "price", "total", "year", "page", "isbn", "no."),
}


#: Fixed examples: what a span of a kind looks like, and (under None) what only looks
#: like one.  In a template # is a digit, % a letter or digit.
EXAMPLES = {
    "id_number": ("ssn ###-##-####", "id ###-##-#### of", "her number is ###-##-####,", "###-##-####", "social security ###-##-#### on file", "id is ###-##-####, and"),
    "key": (
        "key %%%%%%%%%%%%%%%%%%%%%%%%%%%%", "token=%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%", "secret: %%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%",
        "use %%%%%%%%%%%%%%%%%%%%%%%%%%", "password %%%%%%%%%%%%%%%%%%%%%%%%", "api %%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%",
    ),
    "phone": ("call (0##) #### ####", "phone ### ### ####", "tel. 0## ### ####", "mobile 0#### ######", "fax (0###) ### ####", "call ###-###-#### today", "dial ##### ### ###"),
    "email": (
        "mail anna.b [at] site [dot] org", "contact joe(at)host(dot)com", "write to info [at] shop.example", "or k.l# (at) mail.net", "sue## [at] a-b [dot] co [dot] uk",
        "mail a.###### [at] post [dot] org",
    ),
    None: (
        "isbn ###-##-#### no", "page ###-##-#### total", "in ####-##-##", "on ##.##.####", "version ##.##.##", "price ###.##", "total ### ###", "from #### - ####",
        "page ### - ###", "years ####/##", "no. ##-##", "scores ## ## ## ##", "isbn ##-###-####", "row ##### #####", "date ####/##/##", "price ##.### ##",
        "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa#", "name_of_a_long_function_in_code_#", "step-by-step-guide-to-good-soup-#", "------------------------a#", "chapter_##_section_##_part_##_a",
    ),
}
#: Texts made of each template.
EACH = 12


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def account_ok(text: str) -> bool:
    """Remainder 1 by 97 after the country and check digits are put last."""
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """As a scan for local part, @ and domain would find them, looked up from the @."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        else:
            done = max(done, at)
        at = text.find("@", max(done, at + 1))


def rule_spans(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """Matches that pass their check, and matches that fail it: start, kind, end."""
    good, bad = [], []
    if not TRIGGER.search(text):
        return good, bad
    if "@" in text:
        good += [(s, "email", e) for s, e in emails(text)]
    for m in IP.finditer(text):
        # short parts only: a number of many digits is above the limit anyway
        fine = all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split("."))
        (good if fine else bad).append((m.start(), "ip", m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            good.append((m.start(), "card", m.end()))
        elif 12 <= len(digits) <= 22:
            bad.append((m.start(), "card", m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            fine = 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15
            (good if fine else bad).append((m.start(), "phone", m.end()))
    order = KINDS.index
    return sorted(good, key=lambda x: (x[0], order(x[1]))), bad


def proposals(text: str) -> Iterator[tuple[int, str, int, int]]:
    """Further spans; the last number is 1 or 0 where a check settles them, else -1."""
    if "at" in text and ("(at" in text or "[at" in text):
        for m in MASKED.finditer(text):
            yield m.start(), "email", m.end(), -1
    if not TRIGGER.search(text):
        return
    for kind, pattern in MORE:
        for m in pattern.finditer(text):
            known = int(account_ok(m[0])) if kind == "account" else -1
            if kind == "key" and not (re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])):
                continue
            yield m.start(), kind, m.end(), known


def form(text: str, start: int, kind: str, end: int) -> list[float]:
    """Form and context of a span, as numbers."""
    span = text[start : min(end, start + 256)]
    digits = NOT_DIGIT.sub("", span)
    groups = re.findall("[0-9]+", span)
    before = text[max(0, start - 32) : start].lower()
    left, right = text[start - 1 : start], text[end : end + 1]
    times = np.unique(list(span), return_counts=True)[1] / len(span)
    return [
        KINDS.index(kind), len(span), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        max((int(g) for g in groups if len(g) < 7), default=0), sum(c.isalpha() for c in span), sum(c.isupper() for c in span),
        span.count("."), span.count("-"), span.count(" "), span.count("+"), span.count("@"), span.count(":"),
        round(float(-(times * np.log2(times)).sum()), 3), float(bool(digits) and luhn(digits)), float(len(set(digits))),
        float(left.isalnum()), float(right.isalnum()), float(left in ('"', "'", "=", ":", "<", "(")),
        *(float(any(w in before for w in words)) for words in CUES.values()),
    ]


class Picker:
    """Boosted trees with a threshold per kind.  ``forms``: the forms of settled proposals
    (``x``, outcome ``y``, ``held`` out of the fit, ``n`` times it occurs); ``more``: form
    and outcome of the examples; ``known``: how many proposals a check settled, by kind."""

    def __init__(self, forms: DataFrame, more: tuple[np.ndarray, np.ndarray], known: np.ndarray):
        # enough of them for the trees to heed them beside many settled proposals
        times = max(1, int(known.sum()) // (10 * len(more[1])))
        rows = [(x.tolist(), int(y), i % 3 == 0, times, False) for i, (x, y) in enumerate(zip(*more))]
        made = forms.sparkSession.createDataFrame(rows, "x array<double>, y int, held boolean, n bigint, known boolean")
        every = forms.select("x", "y", "held", "n", F.lit(True).alias("known")).unionByName(made)
        self.trees = BoostedTrees().cut(every.where("not held"))
        same = [F.col("x")[0].cast("int").alias("kind"), "known", "held", "y"]
        forms_of = every.select("x", "n", *same).mapInArrow(self.in_bins, "b binary, n bigint, kind int, known boolean, held boolean, y int")
        forms_of = step(forms_of.groupBy("b", "kind", "known", "held", "y").agg(F.sum("n").alias("n")), "binned_forms")
        fit = forms_of.where("not held")
        self.trees.fit_rows(step(fit.repartition(fit.count() // ROWS + 1), "fitted_forms"))
        self.threshold = self.thresholds(forms_of.where("held"))

    def in_bins(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Forms replaced by their bins."""
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([pack(self.trees.binned(x)), *batch.columns[1:]], names=["b", *batch.schema.names[1:]])

    def scored(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Forms replaced by the step of their score."""
        for batch in batches:
            if batch.num_rows:
                score = self.steps(self.trees.scores(unpack(batch)[0]))
                yield pa.RecordBatch.from_arrays([pa.array(score), *batch.columns[1:]], names=["score", *batch.schema.names[1:]])

    def thresholds(self, held: DataFrame) -> np.ndarray:
        """The threshold of each kind, from counts by kind and step of the score."""
        got = held.select("b", "y", "n", "kind", "known").mapInArrow(self.scored, "score bigint, y int, n bigint, kind int, known boolean")
        got = got.groupBy("kind", "known", "score").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("good")).toArrow()
        kind, known, score, n, good = (got.column(i).to_numpy() for i in range(5))
        known = known.astype(bool)
        common, out = self.calibrated(score[known], n[known], good[known]), np.full(len(KINDS), 0.5)
        for k in range(len(KINDS)):
            of = kind == k
            mine = self.calibrated(score[of], n[of], good[of])
            out[k] = max(common, mine) if (known & of).any() else mine
        return out

    @staticmethod
    def steps(p: np.ndarray) -> np.ndarray:
        return np.rint(p * STEPS).astype(np.int64)

    @staticmethod
    def calibrated(score: np.ndarray, n: np.ndarray, good: np.ndarray) -> float:
        """The score from which on enough proposals had passed, half way to the next one
        below; at least one half.  Counts and passed ones come by step of the score."""
        if not len(score):
            return 0.5
        steps, at = np.unique(-score, return_inverse=True)
        upto = [np.cumsum(np.bincount(at, counts)) for counts in (n, good)]
        fine = np.flatnonzero(upto[1] / upto[0] >= PRECISION)
        if not len(fine):
            return 1.01
        below = np.append(-steps, 0)
        return max(0.5, float(below[fine[-1]] + below[fine[-1] + 1]) / 2 / STEPS)

    def pick(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.trees.predict(x)
        return p, self.steps(p) / STEPS >= self.threshold[x[:, 0].astype(int)]


def examples() -> tuple[np.ndarray, np.ndarray]:
    """Form and outcome of the proposals in the fixed examples."""
    r = random.Random(7)
    signs = {"#": "0123456789", "%": "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    x, y = [], []
    for _ in range(EACH):
        for wanted, templates in EXAMPLES.items():
            for template in templates:
                text = "".join(r.choice(signs.get(c, c)) for c in template)
                for start, kind, end, _ in proposals(text):
                    x.append(form(text, start, kind, end))
                    y.append(kind == wanted)
    return np.array(x), np.array(y, float)


def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Form and outcome of the proposals that a check settles, and which are held out."""
    for batch in batches:
        x, y, held = [], [], []
        for text in batch.column(0).to_pylist():
            good, bad = rule_spans(text or "")
            found = [(*s, 1) for s in good] + [(*s, 0) for s in bad]
            found += [s for s in proposals(text or "") if s[3] >= 0] if text else []
            for start, kind, end, known in found:
                x.append(form(text, start, kind, end))
                y.append(known)
                held.append(zlib.crc32(text[max(0, start - 32) : end + 1].encode()) % 3 == 0)
        if x:
            cols = [pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.int32()), pa.array(held, pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=["x", "y", "held"])


def learn(docs: DataFrame, text: str) -> Picker:
    found = docs.select(F.col(text).cast("string")).mapInArrow(settled, "x array<double>, y int, held boolean")
    forms = step(found.groupBy("x", "y", "held").agg(F.count(F.lit(1)).alias("n")), "forms")
    known = np.zeros(len(KINDS), np.int64)
    for r in forms.groupBy(F.col("x")[0].cast("int").alias("kind")).agg(F.sum("n").alias("n")).collect():
        known[r.kind] = r.n
    return Picker(forms, examples(), known)


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first
    gives the name and all are covered."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


def add_spans(text: str, good: list, wanted: list[tuple[float, int, str, int]]) -> list[tuple[int, str, int]]:
    """Rule spans and, best first, the picked ones that overlap no span so far."""
    starts, ends = [], []  # of disjoint stretches taken so far, in order
    for start, _, end in sorted(good):
        if starts and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    out = list(good)
    for _, start, kind, end in sorted(wanted, key=lambda w: (-w[0], w[1:])):
        at = bisect.bisect_left(starts, end)  # stretches that begin before the span ends
        if not at or ends[at - 1] <= start:
            starts.insert(at, start)
            ends.insert(at, end)
            out.append((start, kind, end))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def find(picker: Picker, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            rules, offers, forms = [], [], []
            wanted: dict[int, list] = {}
            for i, text in enumerate(texts):
                good, bad = rule_spans(text)
                rules.append(good)
                more = list(proposals(text))
                for start, kind, end, known in more:
                    if known == 1:
                        wanted.setdefault(i, []).append((1.0, start, kind, end))
                for start, kind, end in bad + [s[:3] for s in more if s[3] != 1]:
                    offers.append((i, start, kind, end))
                    forms.append(form(text, start, kind, end))
            if forms:
                p, yes = picker.pick(np.array(forms))
                for (i, start, kind, end), score, ok in zip(offers, p.tolist(), yes.tolist()):
                    if ok:
                        wanted.setdefault(i, []).append((score, start, kind, end))
            spans = [add_spans(t, g, wanted[i]) if i in wanted else g for i, (t, g) in enumerate(zip(texts, rules))]
            cols = [batch.column(i) for i in range(1, batch.num_columns)]
            for kind in KINDS[:4]:
                cols.append(pa.array([sum(k == kind for _, k, _ in g) for g in rules], pa.int64()))
            cols.append(pa.array([hashlib.sha256(joined(g).encode()).hexdigest() for g in rules], pa.string()))
            cols.append(pa.array([joined(s) for s in spans], pa.string()))
            if with_text:
                cols.append(pa.array([redacted(t, s) for t, s in zip(texts, spans)], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=[str(i) for i in range(len(cols))])

    return run


OUT = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def find_personal_data(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, with_text: bool = True
) -> DataFrame:
    """The columns ``keep`` (all by default), counts and digest of the rule spans, all
    spans, and with ``with_text`` the text with its spans replaced, as ``redacted``."""
    picker = learn(docs, text)
    made = [x.split()[0] for x in (OUT + ", redacted string").split(", ")]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    part = docs.select(F.col(text).cast("string").alias(unused(docs, "_text")), *keep)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in part.schema.fields[1:])
    return part.mapInArrow(find(picker, with_text), kept + OUT + ", redacted string" * with_text)


@query("op7_personal_data")
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"), keep=["doc_id"], with_text=False)
