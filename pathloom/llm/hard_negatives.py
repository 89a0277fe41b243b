"""Hard negatives of anchor vectors by a branch-and-bound scan over dimensions (BOND).

Rows are stored in blocks of columns: a block holds up to BLOCK rows sorted by label, one
array per dimension.  For an anchor the dimensions are read in the order of its largest
magnitudes; after each few of them the least and largest that the unread ones can still
add bound every row's score, and rows whose bounds can't reach a wanted place leave the
candidate set.  What is left at the end has its exact score.

Two scans per chunk of anchors.  The first finds each anchor's positives (the best rows of
its label).  The second finds, for each different positive score, the best rows of other
labels with a score in the window ``low`` to ``high`` percent of it.  The best rows so far
carry on from block to block, so later blocks are cut sooner.  Each task sends at most
``top`` rows per anchor and window, and a window function keeps the first ``top`` of all.

The anchors are a stated query set, of which a chunk of bounded size is broadcast at a
time; rows are never shuffled and never paired beyond a block and an anchor.

Defined results: a row with a null id or label, or with a vector that is null or holds a
null, non-finite or very large component (a score of which might not fit a long), takes
no part, nor does one whose vector has another length than the commonest.  Rows that
repeat an id are rows of their own: each may be positive or negative of the other, each
anchor among them has its own result rows, and ties between them go by content, then by
storage order.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathloom.llm.base import CLEAN, query, setting, step, table
from pathloom.session import materialise, scratch_path

BLOCK = 8192
#: Components of one chunk of anchors, at most.
CHUNK_CELLS = 1 << 20
#: Dimensions read between two looks at the bounds.
STRIDE = 8
#: Largest component: its square times 512 dimensions fits a long.
FAR = 1 << 27

BLOCKS = "n int, keys binary, ids binary, labels binary, dims binary"


def to_blocks(d: int, size: int) -> Callable:
    """Rows (key, id, label, vector) to blocks of columns, each sorted by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            key, ids, label, q = (np.concatenate(x) for x in zip(*held))
            held.clear()
            by = np.lexsort([key, ids, label])
            cells = q[by].T.astype(np.int32)
            row = [x.tobytes() for x in (key[by], ids[by], label[by], cells)]
            return pa.RecordBatch.from_arrays([pa.array([len(by)], pa.int32()), *[pa.array([x], pa.binary()) for x in row]], names=["n", "keys", "ids", "labels", "dims"])

        count = 0
        for batch in batches:
            key, ids, label = (batch.column(i).to_numpy() for i in range(3))
            q = batch.column(3).flatten().to_numpy().reshape(-1, d)
            at = 0
            while at < len(key):
                to = min(len(key), at + size - count)
                held.append((key[at:to], ids[at:to], label[at:to], q[at:to]))
                count += to - at
                at = to
                if count == size:
                    yield flush()
                    count = 0
        if held:
            yield flush()

    return run


class Block:
    """One block: exact columns and their least and largest entries."""

    def __init__(self, row: dict, d: int, exact_as_float: bool):
        n = row["n"]
        self.keys, self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("keys", "ids", "labels"))
        cells = np.frombuffer(row["dims"], np.int32).reshape(d, n)
        self.cells = cells.astype(np.float64 if exact_as_float else np.int64)
        self.least, self.most = self.cells.min(axis=1), self.cells.max(axis=1)

    def same(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]).tolist())


class Best:
    """The first ``top`` rows so far: higher score, then smaller id, then key."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.ids, self.keys = (np.empty(0, np.int64) for _ in range(3))

    def add(self, score: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        if len(score) > 4 * self.top:  # only what reaches the last place that counts
            last = np.partition(score, len(score) - self.top)[len(score) - self.top]
            ok = score >= last
            score, ids, keys = score[ok], ids[ok], keys[ok]
        score, ids, keys = (np.concatenate(x) for x in ((self.score, score), (self.ids, ids), (self.keys, keys)))
        by = np.lexsort([keys, ids, -score])[: self.top]
        self.score, self.ids, self.keys = score[by], ids[by], keys[by]

    def least(self, otherwise: int) -> int:
        return int(self.score[-1]) if len(self.score) == self.top else otherwise


def scan(block: Block, part: slice, anchor: np.ndarray, wanted: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the rows of a part of a block that ``wanted`` keeps.

    Dimensions come by falling magnitude of the anchor.  ``wanted(low, high)`` says which
    rows may still count, given the bounds of their scores."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    a = anchor[order]
    high = np.maximum(a * block.least[order], a * block.most[order])
    low = np.minimum(a * block.least[order], a * block.most[order])
    cells = block.cells[:, part]
    at = None
    score = np.zeros(cells.shape[1], cells.dtype)
    for k in range(0, len(a), STRIDE):
        dims = order[k : k + STRIDE]
        read = cells[dims] if at is None else cells[np.ix_(dims, at)]
        score = score + a[k : k + STRIDE] @ read
        ok = wanted(score + low[k + STRIDE :].sum(), score + high[k + STRIDE :].sum())
        left = np.count_nonzero(ok)
        if left == 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if 4 * left < 3 * len(ok) or k + STRIDE >= len(a):
            at = np.flatnonzero(ok) if at is None else at[ok]
            score = score[ok]
    return at + part.start, score.astype(np.int64)


def positives_in(block: Block, key: int, label: int, anchor: np.ndarray, best: Best) -> None:
    part = block.same(label)
    if part.start == part.stop:
        return
    least = None

    def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        nonlocal least
        # so many rows have at least this score, whatever the unread dimensions add
        if len(low) > best.top + 1:
            sure = np.partition(low, len(low) - best.top - 1)[len(low) - best.top - 1]  # one of them may be the anchor
            least = sure if least is None else max(least, sure)
        reach = best.least(-(1 << 62))
        return high >= (reach if least is None else max(reach, least))

    at, score = scan(block, part, anchor, wanted)
    other = block.keys[at] != key
    at, score = at[other], score[other]
    best.add(score, block.ids[at], block.keys[at])


def negatives_in(block: Block, label: int, anchor: np.ndarray, windows: list[tuple[int, int, Best]]) -> None:
    """Each window (from, to, best) takes its rows of other labels."""
    same = block.same(label)
    for part in (slice(0, same.start), slice(same.stop, len(block.labels))):
        if part.start == part.stop:
            continue

        def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            ok = np.zeros(len(low), bool)
            for least, most, best in windows:
                ok |= (high >= max(least, best.least(least))) & (low <= most)
            return ok

        at, score = scan(block, part, anchor, wanted)
        for least, most, best in windows:
            ok = (score >= max(least, best.least(least))) & (score <= most)
            if ok.any():
                best.add(score[ok], block.ids[at[ok]], block.keys[at[ok]])


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Scores n with low * score <= 100 * n <= high * score."""
    return -((-low * score) // 100), high * score // 100


def floor_div(n: Column) -> Column:
    """n / 100 rounded down, as Python's // does."""
    return F.call_function("div", n - F.pmod(n, F.lit(100)), F.lit(100))


def scan_blocks(sent, d: int, top: int, negatives: bool) -> Callable:
    """The task of either scan: blocks in, each anchor's best rows out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = sent.value
        plain = anchors["exact"]
        vectors = anchors["vectors"].astype(np.float64 if plain else np.int64)
        n = len(vectors)
        if negatives:
            windows = [[(lo, hi, Best(top)) for lo, hi in w] for w in anchors["windows"]]
        else:
            windows = [[(0, 0, Best(top))] for _ in range(n)]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, d, plain)
                for i in range(n):
                    if negatives and windows[i]:
                        negatives_in(block, int(anchors["labels"][i]), vectors[i], windows[i])
                    elif not negatives:
                        positives_in(block, int(anchors["keys"][i]), int(anchors["labels"][i]), vectors[i], windows[i][0][2])
        found = [(i, lo, hi, b) for i, w in enumerate(windows) for lo, hi, b in w if len(b.score)]
        for k in range(0, len(found), 10_000):
            some = found[k : k + 10_000]
            size = [len(b.score) for *_, b in some]
            columns = [np.repeat([int(anchors["keys"][i]) for i, *_ in some], size), *[np.repeat([x[j] for x in some], size) for j in (1, 2)]]
            columns += [np.concatenate([getattr(b, c) for *_, b in some]) for c in ("ids", "keys", "score")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "lo", "hi", "id", "key", "score"])

    return run


FOUND = "anchor long, lo long, hi long, id long, key long, score long"


def first_of(found: DataFrame, top: int) -> DataFrame:
    """The first rows of each anchor and window over all tasks."""
    w = Window.partitionBy("anchor", "lo", "hi").orderBy(F.desc("score"), "id", "key")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    row_id: str = "vec_id",
    label: str = "label",
    vector: str = "q",
    top: int = 5,
    low: int = 80,
    high: int = 100,
    block: int = BLOCK,
    chunk_cells: int = CHUNK_CELLS,
) -> DataFrame:
    """For each row that ``anchor`` marks and each of its ``top`` positives, the first
    ``top`` rows of other labels with a score of ``low`` to ``high`` percent of the
    positive's.  ``vector`` holds whole numbers; scores are inner products."""
    spark = rows.sparkSession
    v = F.col(vector)
    fits = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | (F.abs(x) >= FAR))
    clean = rows.where(F.col(row_id).isNotNull() & F.col(label).isNotNull() & fits)
    clean = clean.select(
        F.col(row_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), v.cast("array<bigint>").alias("q"), F.coalesce(anchor, F.lit(False)).alias("asks")
    )
    clean = step(clean.withColumn("key", F.monotonically_increasing_id()), "vectors")
    lengths = clean.groupBy(F.size("q").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not lengths or lengths[0]["d"] == 0:
        return spark.createDataFrame([], out)
    d = int(lengths[0]["d"])
    clean = clean.where(F.size("q") == d)
    blocks = step(clean.select("key", "id", "label", "q").mapInArrow(to_blocks(d, block), BLOCKS), "blocks")
    asking = clean.where("asks").select("key", "id", "label", "q")
    largest = clean.select(F.max(F.array_max(F.transform("q", F.abs)))).first()[0]
    exact = int(largest) ** 2 * d < 1 << 53
    chunks = max(1, -(-asking.count() * d // chunk_cells))
    asking = step(asking.repartition(chunks).withColumn("chunk", F.spark_partition_id()), "anchors")
    context, folder = spark.sparkContext, scratch_path(spark, "negatives")
    for c in range(chunks):
        mine = asking.where(F.col("chunk") == c).orderBy("key").toArrow()
        if not mine.num_rows and c:
            continue
        sent = {"keys": mine["key"].to_numpy(), "labels": mine["label"].to_numpy(), "exact": exact}
        sent["vectors"] = mine["q"].combine_chunks().flatten().to_numpy().reshape(-1, d)
        first = context.broadcast(sent)
        positives = step(first_of(blocks.mapInArrow(scan_blocks(first, d, top, False), FOUND), top), "positives")
        windows: dict[int, set] = {}
        for r in positives.select("anchor", "score").toLocalIterator():  # at most top per anchor of the chunk
            windows.setdefault(r["anchor"], set()).add(window_of(r["score"], low, high))
        of = [sorted(w for w in windows.get(int(k), ()) if w[0] <= w[1]) for k in sent["keys"]]
        second = context.broadcast({**sent, "windows": of})
        negatives = first_of(blocks.mapInArrow(scan_blocks(second, d, top, True), FOUND), top)
        p = positives.join(asking.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id")), "anchor").select(
            "anchor", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
            (-floor_div(F.col("score") * -low)).alias("lo"), floor_div(F.col("score") * high).alias("hi"),
        )
        done = p.join(negatives, ["anchor", "lo", "hi"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        with setting(spark, CLEAN, "true"):
            materialise(done, path=f"{folder}/chunk={c}")
        first.destroy()
        second.destroy()
    return spark.read.schema(out).parquet(folder).drop("chunk")


ORACLE = """
WITH rows_ AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), pairs AS (
  SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same,
         CAST(list_sum([a.q[i] * r.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ r ON a.id <> r.id
  WHERE a.id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) <= 5
"""


@query("op13_hard_negatives", ORACLE)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label is moved on by one where vec_id is divisible by 7; components become
    floor(256 * x); anchors have a vec_id divisible by 100."""
    df = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    far = float(FAR)  # beyond it a row takes no part
    grid = F.transform("embedding", lambda c: F.floor(F.greatest(F.least(256 * c.cast("double"), F.lit(far)), F.lit(-far))).cast("bigint"))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c))
    rows = df.where(~bad).select("vec_id", moved.alias("label"), grid.alias("q"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)
