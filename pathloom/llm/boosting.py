"""Small gradient-boosted trees with logistic loss, on binned features.

A level of a tree is chosen from sums of gradients by node, feature and bin.  They
are kept as whole numbers, so that any split of the rows into tasks adds up to the
same sums, and with them to the same trees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Gradients are whole multiples of 1 / ONE.
ONE = 2**20


class BoostedTrees:
    """``rounds`` full binary trees of ``depth`` levels; a feature is cut into at
    most ``bins`` bins by quantiles of the training rows."""

    def __init__(self, rounds: int = 40, depth: int = 3, bins: int = 32, rate: float = 0.2, smooth: float = 1.0):
        self.rounds, self.depth, self.bins, self.rate, self.smooth = rounds, depth, bins, rate, smooth
        self.cuts: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def places(self) -> list[float]:
        """Shares of the rows at which a feature is cut."""
        return np.linspace(0, 1, self.bins + 1)[1:-1].tolist()

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(x[:, j], self.places())) for j in range(x.shape[1])]
        b, w = self.binned(x), np.ones(len(y))
        return self.grow(float(y.mean()), lambda *tree: self.sums(b, y, w, *tree))

    def cut(self, rows: DataFrame) -> BoostedTrees:
        """Cuts from all rows (``x`` array, ``n`` times it occurs).  Rows of one feature
        and value are counted first, so a task holds different values only."""
        values = rows.select(F.posexplode("x").alias("j", "v"), "n").groupBy("j", "v").agg(F.sum("n").alias("n"))
        found = values.groupBy("j").agg(F.percentile("v", F.lit(self.places()), F.col("n")).alias("cuts")).collect()
        self.cuts = [np.unique(r.cuts) for r in sorted(found, key=lambda r: r.j)]
        return self

    def fit_rows(self, rows: DataFrame) -> BoostedTrees:
        """As ``fit``, on a table of binned rows: ``b`` (a byte per feature), ``y``, ``n``.
        Each level is one pass over all of them; a task returns its sums."""

        def sums(*tree) -> np.ndarray:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total = None
                for batch in batches:
                    if batch.num_rows:
                        b, y, n = unpack(batch)
                        part = self.sums(b, y, n, *tree)
                        total = part if total is None else total + part
                if total is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

            parts = rows.select("b", "y", "n").mapInArrow(run, "s binary").collect()
            return sum(np.frombuffer(r.s, np.int64) for r in parts)

        total = rows.agg(F.sum(F.col("y") * F.col("n")).alias("y"), F.sum("n").alias("n")).first()
        return self.grow(total.y / total.n, sums)

    def grow(self, share: float, sums: Callable[..., np.ndarray]) -> BoostedTrees:
        """All trees, from the share of class 1 and the sums over all rows."""
        share = np.clip(share, 1e-3, 1 - 1e-3)
        self.start, n_feat, width = float(np.log(share / (1 - share))), len(self.cuts), self.bins
        for _ in range(self.rounds):
            feats, at = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, width, np.int64)
            for level in range(self.depth):
                n_node = 2**level
                gs, hs = sums(feats, at, level).reshape(2, n_node, n_feat, width).cumsum(axis=3) / ONE
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs**2 / (hs + self.smooth) + (gt - gs) ** 2 / (ht - hs + self.smooth) - gt**2 / (ht + self.smooth)
                best = gain.reshape(n_node, -1).argmax(axis=1)
                node = np.arange(n_node)
                feats[n_node - 1 + node], at[n_node - 1 + node] = best // width, best % width
            left = node, best // width, best % width
            g, h = (np.stack([s[left], s[:, 0, -1] - s[left]], axis=1).ravel() for s in (gs, hs))
            self.trees.append((feats, at, -self.rate * g / (h + self.smooth)))
        return self

    @staticmethod
    def node(b: np.ndarray, feats: np.ndarray, at: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after so many levels of a tree."""
        rows, node = np.arange(len(b)), np.zeros(len(b), np.int64)
        for level in range(levels):
            spot = 2**level - 1 + node
            node = 2 * node + (b[rows, feats[spot]] > at[spot])
        return node

    def scores(self, b: np.ndarray) -> np.ndarray:
        """Probability of class 1 per binned row."""
        z = np.full(len(b), self.start)
        for feats, at, value in self.trees:
            z += value[self.node(b, feats, at, self.depth)]
        return 1 / (1 + np.exp(-z))

    def sums(self, b: np.ndarray, y: np.ndarray, n: np.ndarray, feats: np.ndarray, at: np.ndarray, level: int) -> np.ndarray:
        """Gradients and their slopes by node of a level, feature and bin, of rows that
        occur ``n`` times, after all trees so far."""
        n_feat, width, p = b.shape[1], self.bins, self.scores(b)
        key = (self.node(b, feats, at, level)[:, None] * (n_feat * width) + np.arange(n_feat) * width + b).ravel()
        parts = (np.rint((p - y) * ONE) * n, np.rint(p * (1 - p) * ONE) * n)
        size = 2**level * n_feat * width
        return np.concatenate([np.bincount(key, np.repeat(part, n_feat), size) for part in parts]).astype(np.int64)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 per row."""
        return self.scores(self.binned(x))


def pack(b: np.ndarray) -> pa.Array:
    """Bins of rows, a byte each."""
    return pa.array([r.tobytes() for r in b.astype(np.uint8)], pa.binary())


def unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, outcomes and counts of the rows of a batch."""
    rows = b"".join(batch.column("b").to_pylist())
    b = np.frombuffer(rows, np.uint8).reshape(batch.num_rows, -1).astype(np.int64)
    return b, batch.column("y").to_numpy(), batch.column("n").to_numpy()
