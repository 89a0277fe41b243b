"""A quality classifier learnt from trusted positives and unlabelled text.

The classifier is additive over binned text-shape features.  It minimises the
non-negative unbiased risk of positive-unlabelled learning,
``p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)])``, with the logistic loss, the
class prior p being the share of positives among the labelled training rows.
Where the second term falls below zero the step goes the other way, so that the
model can't win by overfitting the positives.  The scores are then calibrated by a
logistic line on labelled training rows, where these hold both classes.

One pass over the texts makes the features (a few numbers a document, written as a
table); the fit takes at most ``SAMPLE`` rows of either kind, chosen by hash; all
rows are scored.  Nothing of the labels, the language, the source or the id goes
into a feature.

Defined results: a null text is empty and is scored like any other; labels that are
null, or whose doc_id is null, are not used; with no positive label every score is
0.5; each row is scored alone, so rows that share a doc_id may differ; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import query, step, table
from pathloom.llm.quality_rules import in_doc, per_doc, repeated_lines, repeated_words
from pathloom.llm.textcols import IS_SPACE, Texts, slices

#: Most rows of each kind (positive, unlabelled, labelled for calibration) in the fit.
SAMPLE = 20_000
BINS = 24
ROUNDS, RATE, SHRINK = 300, 0.05, 1e-3

CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "stop": b".,;:!?", "symbol": b"#*$%&|<>",
    "quote": b"\"'`()[]{}", "other": b"+-/=@\\^_~", "far": range(0x80, 0x100), "line": b"\n",
}


def class_tables() -> dict[str, np.ndarray]:
    out = {}
    for name, codes in CLASSES.items():
        out[name] = np.zeros(256, np.int64)
        out[name][list(codes)] = 1
    return out


def features(texts: Texts, tables: dict[str, np.ndarray]) -> np.ndarray:
    """A row of shape features per document."""
    words, buf, off, n = texts.words(lower=True), texts.buf, texts.off, len(texts)
    n_words = np.diff(words.first)
    some, size = np.maximum(n_words, 1), np.maximum(np.diff(off), 1)
    count = {k: per_doc(t[buf], off) for k, t in tables.items()}
    length = (words.end - words.start).astype(float)
    total = np.bincount(words.doc, weights=length, minlength=n)
    square = np.bincount(words.doc, weights=length * length, minlength=n)
    mean = total / some
    cols = [np.log1p(n_words), mean, np.sqrt(np.maximum(square / some - mean * mean, 0)), per_doc(IS_SPACE[buf].astype(np.int64), off) / size]
    cols += [count[k] / size for k in CLASSES]
    cols += [count["upper"] / np.maximum(count["upper"] + count["lower"], 1), n_words / (count["line"] + 1)]
    keys = in_doc(words.hash, words.doc)
    order = np.argsort(keys)
    lead = np.flatnonzero(np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]])) if len(keys) else np.empty(0, np.int64)
    times = np.diff(np.append(lead, len(keys)))
    most = np.zeros(n)
    np.maximum.at(most, words.doc[order[lead]], times)
    cols += [np.bincount(words.doc[order[lead]], minlength=n) / some, most / some]
    twin = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    cols += [np.bincount(words.doc[1:][twin], minlength=n) / some, repeated_words(words, 8) / some, repeated_lines(texts, words) / (count["line"] + 1)]
    tail, front = buf[words.end - 1], buf[words.start]
    for name in ("stop", "symbol", "digit", "upper"):
        cols.append(np.bincount(words.doc, weights=tables[name][tail], minlength=n) / some)
    cols.append(np.bincount(words.doc, weights=tables["upper"][front], minlength=n) / some)
    cols.append(np.bincount(words.doc, weights=length > 20, minlength=n) / some)
    cols.append(np.bincount(words.doc, weights=length <= 2, minlength=n) / some)
    return np.stack(cols, axis=1).astype(np.float32)


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = class_tables()
    for batch in batches:
        for a, b, texts in slices(batch.column(1)):
            x = features(texts, tables)
            border = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[a:b], pa.ListArray.from_arrays(border, pa.array(x.reshape(-1)))], names=["doc_id", "x"]
            )


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def matrix(got: pa.Table) -> np.ndarray:
    """The feature lists of a table, one row each."""
    rows = got.column("x").combine_chunks()
    return rows.flatten().to_numpy().reshape(len(rows), -1) if len(rows) else np.empty((0, 0), np.float32)


class Additive:
    """A sum of one weight per feature, chosen by the feature's bin."""

    def __init__(self, x: np.ndarray):
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        self.first = np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])])
        self.w, self.bias = np.zeros(self.first[-1]), 0.0
        self.line = (1.0, 0.0)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "right") + self.first[j] for j, c in enumerate(self.cuts)], axis=1)

    def value(self, bins: np.ndarray) -> np.ndarray:
        return self.w[bins].sum(axis=1) + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.line[0] * self.value(self.bins(x)) + self.line[1])

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> None:
        """Adam steps on the non-negative risk."""
        p, u = self.bins(positive), self.bins(unlabelled)
        m, v = np.zeros(len(self.w) + 1), np.zeros(len(self.w) + 1)
        for k in range(1, ROUNDS + 1):
            zp, zu = self.value(p), self.value(u)
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            # slopes of the two parts of the risk with respect to the values
            plus = -prior * sigmoid(-zp) / len(p)
            minus_p, minus_u = -prior * sigmoid(zp) / len(p), sigmoid(zu) / len(u)
            gp, gu = (plus + minus_p, minus_u) if negative >= 0 else (-minus_p, -minus_u)
            g = np.bincount(p.ravel(), np.repeat(gp, p.shape[1]), len(self.w)) + np.bincount(u.ravel(), np.repeat(gu, u.shape[1]), len(self.w))
            g = np.append(g + SHRINK * self.w, gp.sum() + gu.sum())
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            move = RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
            self.w -= move[:-1]
            self.bias -= move[-1]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Slope and offset by Newton steps on the labelled rows, lightly damped."""
        z = self.value(self.bins(x))
        a = np.stack([z, np.ones_like(z)], axis=1)
        line = np.array([1.0, 0.0])
        for _ in range(50):
            s = sigmoid(a @ line)
            g = a.T @ (s - y) + 1e-2 * (line - (1.0, 0.0))
            line = line - np.linalg.solve((a * (s * (1 - s))[:, None]).T @ a + 1e-2 * np.eye(2), g).clip(-2, 2)
        self.line = (float(line[0]), float(line[1]))


def train(made: DataFrame, labels: DataFrame, learns: Column, label: str, sample: int = SAMPLE) -> Additive | None:
    """The classifier, from labelled rows marked by ``learns`` and from features."""
    seen = labels.where(learns & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    seen = seen.select("doc_id", F.col(label).cast("int").alias("y")).dropDuplicates(["doc_id"])
    shares = seen.agg(F.avg((F.col("y") == 1).cast("int"))).first()[0]
    if not shares:
        return None

    def some(rows: DataFrame) -> DataFrame:
        return rows.orderBy(F.xxhash64(F.col("doc_id"), F.lit(7)), "doc_id").limit(sample)

    def vectors(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        got = made.join(F.broadcast(rows), "doc_id").orderBy("doc_id").select("x", "y").toArrow()
        return matrix(got), got.column("y").to_numpy()

    positive, _ = vectors(some(seen.where("y = 1")))  # at most `sample` short rows are broadcast
    both, y = vectors(some(seen))
    unlabelled = matrix(some(made.where(learns)).select("x").toArrow())
    if not len(positive) or not len(unlabelled):
        return None
    model = Additive(unlabelled)
    model.fit(positive, unlabelled, float(shares))
    if 0 < y.sum() < len(y):
        model.calibrate(both, y)
    return model


def score_rows(model: Additive | None, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            score = np.full(n, 0.5)
            if model is not None and n:
                score = model.score(batch.column(2).flatten().to_numpy().reshape(n, -1))
            cols = [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "score", "predicted"])

    return run


def classify(
    docs: DataFrame, labels: DataFrame, held: Column, label: str = "quality", text: str = "text", threshold: float = 0.7
) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.  ``held`` is an expression on
    doc_id that marks the rows whose labels must not be learnt from."""
    part = docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string"))
    made = step(part.mapInArrow(feature_rows, "doc_id bigint, x array<float>"), "shape_features")
    model = train(made, labels, ~held, label)
    ddl = "doc_id bigint, held_out boolean, score double, predicted int"
    return made.select("doc_id", held.alias("held_out"), "x").mapInArrow(score_rows(model, threshold), ddl)


@query("op5_pu_quality")
def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held)
