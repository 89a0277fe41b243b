"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document is its set of distinct word shingles.  Documents with the same set are
one class, known by a 128-bit sum.  A class has a signature of ``TREES * DEPTH``
minima; each tree sorts the classes by its own ``DEPTH`` minima.  Classes that share
the first ``LEAST_DEPTH`` minima of a tree form a region.  A region that is larger
than a block is cut along longer and longer common prefixes, so dense regions are
searched deeper; within a block the neighbours are compared by signature, and the
links of greatest estimated similarity that hold the block together become candidates.
Candidates are confirmed on full sets.  In a second round the blocks whose classes are
not yet one component get the full sets of the classes that are alike across
components, and every such pair is tested in place; only links that join two
components leave the block.  Components come from the confirmed links.

A pair at the least similarity misses a region in all trees with odds below one in
a million, and its estimate falls below the bar with odds of that size too.

Regions above a block are cut, by deeper prefixes and in the end by order, so a pair in
them may be parted in every tree: texts filled into one form are such a region.  Classes
with such regions in more than ``TREES - FREE`` trees (a pair misses the others with odds
of 1e-5) that are not one component afterwards are joined exactly: in an order of their
shingles from rare to common, two sets at the bar share one of the first few shingles
(the prefix filter, shorter for the smaller set, with what their places leave of a
possible overlap), and pairs that do are confirmed on full sets.  The order comes from a
histogram of fixed size.

Copies are pre-aggregated, no pairs of copies are made, a block has a fixed size, and
its candidates in the first round number no more than its rows.  Regions are dealt
out by ranges of the sorted orders: one of at most a block is never split, a larger one
is split over tasks.

Defined results: a null text or one without words has no shingles and is linked with
nothing; a text of fewer words than a shingle is one shingle; a null doc_id is the
least id; rows that share a doc_id are the same node, so their links add up; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import query, step, table
from pathloom.llm.components import components
from pathloom.llm.quality_rules import in_doc
from pathloom.llm.substring_dedup import runs
from pathloom.llm.textcols import NO_ID, U64, int64_column, mix, slices

TREES, DEPTH, LEAST_DEPTH = 16, 8, 3
#: Classes compared with each other at once, and candidates' least estimate below the bar.
BLOCK, MARGIN = 512, 0.15
#: Trees without a region above a block that a class needs to go without the exact join.
FREE = 12
#: Cells of the histogram that orders shingles by how common they are.
CELLS = 1 << 20

_K = TREES * DEPTH
SCALE = mix(np.arange(1, _K + 1, dtype=U64)) | U64(1)
SHIFT = mix(np.arange(_K + 1, 2 * _K + 1, dtype=U64))
#: Stands for a short text's only shingle, so that it differs from a full one.
SHORT = U64(0x5851F42D4C957F2D)


def shingle_sets(words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each document and the border of each document."""
    h, at = words.windows(n)
    doc = words.doc[at]
    size = np.diff(words.first)
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        for k in range(1, n):
            some = short[size[short] == k]
            if len(some):
                whole, first = words.windows(k)
                h = np.append(h, mix(whole[np.searchsorted(first, words.first[some])] + SHORT))
                doc = np.append(doc, some)
    order = np.argsort(in_doc(h, doc))
    h, doc = h[order], doc[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.empty(0, bool)
    h, doc = h[new], doc[new]
    order = np.argsort(doc, kind="stable")
    return h[order], np.searchsorted(doc[order], np.arange(len(size) + 1))


def set_sums(h: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums that name a set."""
    out = []
    for salt in (U64(0x2545F4914F6CDD1D), U64(0x9E6C63D0876A9A47)):
        total = np.zeros(len(h) + 1, U64)
        np.cumsum(mix(h ^ salt), out=total[1:])
        out.append((total[border[1:]] - total[border[:-1]]).astype(np.int64))
    return out[0], out[1]


def sign(n: int):
    """Per document: its set's size, name and signature (big-endian, so that parts of
    it sort as numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = int64_column(batch.column(0))
            for a, b, texts in slices(batch.column(1)):
                h, border = shingle_sets(texts.words(lower=True), n)
                size = np.diff(border)
                some = np.flatnonzero(size)
                minima = np.empty((len(some), _K), ">u4")
                if len(some):
                    for k in range(_K):
                        minima[:, k] = np.minimum.reduceat((h * SCALE[k] + SHIFT[k]) >> U64(32), border[some])
                data = minima.tobytes()
                signs: list = [None] * (b - a)
                for j, i in enumerate(some.tolist()):
                    signs[i] = data[4 * _K * j : 4 * _K * (j + 1)]
                first, second = set_sums(h, border)
                cols = [pa.array(ids[a:b]), pa.array(size), pa.array(first), pa.array(second), pa.array(signs, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc", "n_shingles", "fp1", "fp2", "sign"])

    return run


SIGNED = "doc bigint, n_shingles bigint, fp1 bigint, fp2 bigint, sign binary"


def blocks(keys: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of sorted rows that share a prefix of minima, cut along deeper prefixes
    while larger than ``size``.  Column 0 of ``keys`` is the tree."""
    waiting = [(0, len(keys), LEAST_DEPTH)]
    split = [(keys[1:, : d + 1] != keys[:-1, : d + 1]).any(axis=1) for d in range(LEAST_DEPTH, DEPTH + 1)]
    while waiting:
        lo, hi, depth = waiting.pop()
        if depth > DEPTH:  # the same minima all the way: neighbours in the order
            for a in range(lo, hi, size):
                if min(a + size, hi) - a > 1:
                    yield a, min(a + size, hi)
            continue
        cuts = lo + 1 + np.flatnonzero(split[depth - LEAST_DEPTH][lo : hi - 1])
        edges = np.concatenate([[lo], cuts, [hi]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a > size:
                waiting.append((a, b, depth + 1))
            elif b - a > 1:
                yield a, b


def likeness(s: np.ndarray) -> np.ndarray:
    """Shares of equal minima of all pairs of a block."""
    out = np.empty((len(s), len(s)), np.float32)
    for a in range(0, len(s), 32):
        out[a : a + 32] = (s[a : a + 32, None, :] == s[None, :, :]).mean(axis=2, dtype=np.float32)
    return out


def holding_links(like: np.ndarray, least: float) -> list[tuple[int, int]]:
    """A forest of greatest likeness over the pairs at or above ``least``: every group
    takes its best link to another group until none is left."""
    m = len(like)
    label, out = np.arange(m), []
    while True:
        open_ = np.where(label[:, None] != label[None, :], like, -1)
        best = open_.argmax(axis=1)
        value = open_[np.arange(m), best]
        order = np.lexsort((best, np.arange(m), -value, label))
        lead = order[np.concatenate([[True], label[order[1:]] != label[order[:-1]]])]
        lead = lead[value[lead] >= least]
        if not len(lead):
            return out
        for i in lead.tolist():
            a, b = label[i], label[best[i]]
            if a != b:
                out.append((i, int(best[i])))
                label[label == max(a, b)] = min(a, b)


def candidates(least: float, final: bool):
    """From rows (tree, key, sign, class, component) in order: candidate pairs or, in the
    final round, the blocks and those of their classes that are alike to a class of
    another component.  A region that comes in several batches is held together up to
    a few blocks."""
    made = 0

    def pairs(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal made
        whole = pa.Table.from_batches(rows)
        n = whole.num_rows
        key = np.frombuffer(b"".join(whole.column("key").to_pylist()), ">u4").reshape(n, DEPTH).astype(np.int64)
        keys = np.column_stack([whole.column("tree").to_numpy(), key])
        node, comp = whole.column("node").to_numpy(), whole.column("component").to_numpy()
        data = whole.column("sign").to_pylist()
        found: list[tuple[int, int]] = []
        for lo, hi in blocks(keys, BLOCK):
            if final and (comp[lo:hi] == comp[lo]).all():
                continue
            if final:
                s = np.frombuffer(b"".join(data[lo:hi]), np.uint32).reshape(hi - lo, _K)
                near = (likeness(s) >= least) & (comp[lo:hi, None] != comp[None, lo:hi])
                some = lo + np.flatnonzero(near.any(axis=1))
                if len(some):
                    made += 1
                    name = f"{TaskContext.get().partitionId()}-{made}"
                    cols = [pa.array([name] * len(some)), pa.array(node[some]), pa.array(comp[some])]
                    yield pa.RecordBatch.from_arrays(cols, names=["block", "node", "component"])
                continue
            s = np.frombuffer(b"".join(data[lo:hi]), np.uint32).reshape(hi - lo, _K)
            if hi - lo == 2:
                if np.count_nonzero(s[0] == s[1]) >= least * _K:
                    found.append((lo, lo + 1))
                continue
            found += [(lo + i, lo + j) for i, j in holding_links(likeness(s), least)]
        if found:
            a, b = (node[list(x)] for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in (piece for b in batches for piece in (b[i : i + BLOCK] for i in range(0, b.num_rows, BLOCK))):
            if held and size >= 4 * BLOCK:
                # give out all regions but the last, or all when the last alone is that long
                whole = pa.Table.from_batches(held).combine_chunks()
                tree, key = whole.column("tree").to_pylist(), whole.column("key").to_pylist()
                cut, mine = size, (tree[-1], key[-1][: 4 * LEAST_DEPTH])
                while cut and (tree[cut - 1], key[cut - 1][: 4 * LEAST_DEPTH]) == mine:
                    cut -= 1
                cut = cut if cut and size - cut < 4 * BLOCK else size
                yield from pairs(whole.slice(0, cut).to_batches())
                held = whole.slice(cut).to_batches() if cut < size else []
                size -= cut
            held.append(batch)
            size += batch.num_rows
        if held:
            yield from pairs(held)

    return run


def sets_of(n: int):
    """The sorted shingle set of each text whose set has the wanted name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = int64_column(batch.column(0))
            want = [int64_column(batch.column(i)) for i in (2, 3)]
            for a, b, texts in slices(batch.column(1)):
                h, border = shingle_sets(texts.words(lower=True), n)
                first, second = set_sums(h, border)
                fits = np.flatnonzero((first == want[0][a:b]) & (second == want[1][a:b]))
                sets = [np.sort(h[border[i] : border[i + 1]]).tobytes() for i in fits.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b][fits]), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def confirm(percent: int):
    """Pairs whose sets meet the bar: 100 * common >= percent * all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                at = np.searchsorted(p, q)
                common = int(np.count_nonzero(p[np.minimum(at, len(p) - 1)] == q))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    m = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values)
    values, owner = values[order], owner[order]
    first, count = runs(values)
    column = np.repeat(np.arange(len(first)), count)
    shared = np.repeat(count > 1, count)
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    out, width = np.zeros((m, m), np.float32), 4096
    for a in range(0, int(column.max()) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, (a, a + width))
        part = np.zeros((m, width), np.float32)
        part[owner[lo:hi], column[lo:hi] - a] = 1
        out += part @ part.T
    return out.astype(np.int64)


def cross_links(percent: int):
    """The links of a block that join two components, as few as hold them together."""

    def run(block: pa.Table) -> pa.Table:
        node, comp = block.column("node").to_numpy(), block.column("component").to_numpy()
        order = np.argsort(node)  # the same links whatever the order of arrival
        node, comp = node[order], comp[order]
        data = block.column("shingles").to_pylist()
        sets = [np.frombuffer(data[i], U64) for i in order.tolist()]
        size = np.array([len(s) for s in sets], np.int64)
        common = common_counts(sets)
        hit = 100 * common >= percent * (size[:, None] + size[None, :] - common)
        _, label = np.unique(comp, return_inverse=True)
        out = []
        for i, j in np.argwhere(np.triu(hit & (comp[:, None] != comp[None, :]), 1)).tolist():
            if label[i] != label[j]:
                out.append((node[i], node[j]))
                label[label == label[i]] = label[j]
        return pa.table([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def cell_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> U64(44)).astype(np.int64)


def count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles of the sets fall in each cell, as far as this task goes."""
    total = np.zeros(CELLS, np.int64)
    for batch in batches:
        for x in batch.column(0):
            total += np.bincount(cell_of(np.frombuffer(x.as_buffer(), U64)), minlength=CELLS)
    cell = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])


TOKENS = "shingle bigint, node bigint, component bigint, size bigint, place bigint, indexed boolean"


def prefixes(percent: int, common):
    """The shingles of each set (node, component, shingles) that a similar set must share
    one of: the rarest of them, fewer (``indexed``) towards a set at least as large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, comp = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, x in enumerate(batch.column(2)):
                s = np.frombuffer(x.as_buffer(), U64)
                n = len(s)
                probe = n + (-percent * n) // 100 + 1
                index = n + (-2 * percent * n) // (100 + percent) + 1
                first = np.lexsort([s, common.value[cell_of(s)]])[:probe]
                place = np.arange(probe)
                cols = [s[first].astype(np.int64), np.full(probe, node[i]), np.full(probe, comp[i]), np.full(probe, n), place, place < index]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["shingle", "node", "component", "size", "place", "indexed"])

    return run


class Forest:
    """The classes of a corpus, their sorted orders and their confirmed links."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, n: int, percent: int):
        self.n, self.percent = n, percent
        self.docs = docs.select(
            F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("doc"), F.col(text).cast("string").alias("text")
        )
        self.signed = step(self.docs.mapInArrow(sign(n), SIGNED), "signatures")
        classes = self.signed.where("n_shingles > 0").groupBy("fp1", "fp2")
        self.classes = step(classes.agg(F.min("doc").alias("node"), F.first("sign").alias("sign")), "classes")
        trees = F.explode(F.array(*[F.lit(t) for t in range(TREES)])).alias("tree")
        rows = self.classes.select("node", "sign", trees)
        rows = rows.select("node", "tree", F.expr(f"substring(sign, {4 * DEPTH} * tree + 1, {4 * DEPTH})").alias("key"))
        rows = rows.withColumn("region", F.xxhash64("tree", F.expr(f"substring(key, 1, {4 * LEAST_DEPTH})")))
        # written, so that the join with it is one that Spark can split where a region is large
        shared = rows.groupBy("region").agg(F.count("*").alias("n")).where("n > 1")
        shared = step(shared.select("region", (F.col("n") > BLOCK).alias("dense")), "regions")
        self.rows = step(rows.join(shared, "region"), "forest")

    def candidates(self, component: DataFrame | None) -> DataFrame:
        """Candidate pairs of the first round, or blocks of the last, after ``component``."""
        rows = self.rows
        if component is None:
            rows = rows.withColumn("component", F.col("node"))
        else:
            rows = step(rows.join(component, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
            mixed = rows.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
            rows = rows.join(step(mixed.where("lo < hi").select("region"), "mixed"), "region", "left_semi")
        rows = rows.join(self.classes.select("node", "sign"), "node").select("tree", "key", "sign", "node", "component", "dense")
        region = F.expr(f"substring(key, 1, {4 * LEAST_DEPTH})")
        rows = rows.repartitionByRange("tree", region, F.when(F.col("dense"), F.col("key"))).drop("dense")
        rows = rows.sortWithinPartitions("tree", "key", "node")
        least = self.percent / 100 - MARGIN
        if component is None:
            return rows.mapInArrow(candidates(least, False), "a bigint, b bigint").distinct()
        return rows.mapInArrow(candidates(least, True), "block string, node bigint, component bigint")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """Full sets of some classes.  Each text concerned is read once."""
        named = self.classes.select("node", "fp1", "fp2").join(nodes, "node", "left_semi")
        some = self.docs.join(named, self.docs.doc == named.node).select("doc", "text", "fp1", "fp2")
        sets = some.mapInArrow(sets_of(self.n), "node bigint, shingles binary")
        return step(sets.dropDuplicates(["node"]), "shingle_sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The candidate pairs that hold on full sets."""
        sets = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
        both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
        return step(both.mapInArrow(confirm(self.percent), "a bigint, b bigint"), "near_links")

    def components(self) -> DataFrame:
        """Component of every class that has a link."""
        links = self.links(step(self.candidates(None), "pairs"))
        now = step(components(links), "components")
        for more in (self.block_links, self.dense_links):
            found = more(now)
            if found is not None and not found.isEmpty():
                links = links.union(found)
                now = step(components(links), "components")
        return now

    def block_links(self, component: DataFrame) -> DataFrame | None:
        """Links between components inside blocks, tested on full sets in place."""
        rest = step(self.candidates(component), "blocks")
        if rest.isEmpty():
            return None
        full = rest.join(self.sets(rest.select("node").distinct()), "node")
        return step(full.groupBy("block").applyInArrow(cross_links(self.percent), "a bigint, b bigint"), "near_links")

    def dense_links(self, component: DataFrame) -> DataFrame | None:
        """All links between components in regions above a block, by a prefix filter."""
        rows = self.rows.where("dense").select("region", "node")
        often = step(rows.groupBy("node").count().where(F.col("count") > TREES - FREE).select("node"), "often_dense")
        if often.isEmpty():
            return None
        placed = rows.join(often, "node", "left_semi")
        placed = placed.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
        placed = step(placed, "dense_rows")
        mixed = placed.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        mixed = step(mixed.where("lo < hi").select("region"), "dense_mixed")
        nodes = step(placed.join(mixed, "region", "left_semi").select("node", "component").distinct(), "dense")
        if nodes.isEmpty():
            return None
        sets = self.sets(nodes.select("node"))
        common = np.zeros(CELLS, np.int64)
        for r in sets.select("shingles").mapInArrow(count_cells, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            common[r["cell"]] = r["n"]
        sent = nodes.sparkSession.sparkContext.broadcast(common)
        tokens = nodes.join(sets, "node").select("node", "component", "shingles").mapInArrow(prefixes(self.percent, sent), TOKENS)
        tokens = step(tokens, "rare_shingles")
        large = tokens.select("shingle", *[F.col(c).alias(f"x_{c}") for c in ("node", "component", "size", "place")])
        small = tokens.where("indexed").select("shingle", *[F.col(c).alias(f"y_{c}") for c in ("node", "component", "size", "place")])
        before = (F.col("y_size") < F.col("x_size")) | ((F.col("y_size") == F.col("x_size")) & (F.col("y_node") < F.col("x_node")))
        fits = 100 * F.col("y_size") >= self.percent * F.col("x_size")
        # from the first shared shingle on, no more can be shared than either set has left
        left = F.least(F.col("x_size") - F.col("x_place"), F.col("y_size") - F.col("y_place"))
        fits &= (100 + self.percent) * left >= self.percent * (F.col("x_size") + F.col("y_size"))
        met = small.join(large, "shingle").where((F.col("y_component") != F.col("x_component")) & before & fits)
        pairs = met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
        return self.links(step(pairs, "dense_pairs"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 85
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id reachable over links
    of at least ``percent`` similarity), kept (doc_id = component_id)."""
    forest = Forest(docs, doc_id, text, n, percent)
    found = forest.components().withColumnRenamed("node", "class")
    classes = forest.classes.select("fp1", "fp2", F.col("node").alias("class"))
    classes = classes.join(found, "class", "left").select("fp1", "fp2", F.coalesce("component", "class").alias("component"))
    rows = forest.signed.select("doc", "n_shingles", "fp1", "fp2").join(classes, ["fp1", "fp2"], "left")
    component = F.coalesce("component", "doc")
    return rows.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        "n_shingles",
        F.when(component != NO_ID, component).alias("component_id"),
        (F.col("doc") == component).alias("kept"),
    )


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, sha256(array_to_string(ws[i:i + 4], ' ')) AS h FROM (
    SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)
), reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e.v, r.c FROM reach r JOIN (SELECT a AS u, b AS v FROM links UNION ALL SELECT b, a FROM links) e ON e.u = r.doc_id
), least AS (
  SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query("op2_near_dedup", SQL)
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
