"""Cost matrices in long form: (origin, target, value) rows and their checks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.functions import geom as G
from pathloom.functions.text import COST_BIN_LAST, COST_BINS, cost_bin, distance_band
from pathloom.operators.ranks import counted_quantiles, quantiles
from pathloom.session import materialise, setting, shuffle_width

# Points on one side of a tile of the full matrix.
TILE_POINTS = 1024

# Whether a join needs both sides dealt out by all of its keys.
TOGETHER_BY_SOME_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"

# Whether the shuffle files of a job go as soon as it is done.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def od_costs(near: DataFrame, reached: DataFrame) -> DataFrame:
    """Reached nodes that belong to a centroid, by pair of centroids.

    ``near`` is the nearest-node table; ``reached`` holds the reach of the
    distinct nodes in it.  Centroids on one node share its reach.
    """
    start = near.select(F.col("centroid_id").alias("start_centroid"), F.col("node_id").alias("origin"))
    target = near.select(
        F.col("centroid_id").alias("target_centroid"),
        F.col("node_id").alias("node"),
        F.col("dist").alias("node_centroid_dist"),
        "x",
        "y",
    )
    return reached.join(target, "node").join(start, "origin").select(
        "start_centroid",
        F.col("origin").alias("start_node"),
        F.col("node").alias("target_node"),
        *[c for c in reached.columns if c not in ("origin", "node")],
        "target_centroid",
        "node_centroid_dist",
        "x",
        "y",
    )


def long_matrix(od: DataFrame) -> DataFrame:
    """origin, target, value; a pair that occurs twice is an error."""
    once = od.groupBy("start_centroid", "target_centroid").agg(
        F.max("agg_cost").alias("value"), F.count(F.lit(1)).alias("n")
    )
    guard = F.when(F.col("n") > 1, F.raise_error(F.lit("a pair of centroids occurs twice")))
    return once.select(
        F.col("start_centroid").alias("origin"),
        F.col("target_centroid").alias("target"),
        F.coalesce(guard.cast("double"), F.col("value")).alias("value"),
    )


class Tiles:
    """A square cut of the full matrix: both axes fall into ``side`` blocks of points."""

    def __init__(self, near: DataFrame):
        count, width = near.count(), shuffle_width(near.sparkSession)
        self.side = max(math.ceil(count / TILE_POINTS), math.ceil(math.sqrt(width)))

    def block(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.side)).cast("bigint")

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows with a ``tile``, those of a tile together.  The number of partitions is
        given, so that small inputs are not put together before n² rows come of them."""
        return rows.repartition(self.side**2, "tile")

    def pairs(self, near: DataFrame) -> DataFrame:
        """tile, origin, target, value: the straight distance of every pair."""
        every = F.explode(F.sequence(F.lit(0), F.lit(self.side - 1))).alias("other")
        points = near.select("centroid_id", "x", "y", self.block("centroid_id").alias("own"), every)
        rows = points.select(
            F.col("centroid_id").alias("origin"), F.col("x").alias("ox"), F.col("y").alias("oy"),
            (F.col("own") * self.side + F.col("other")).alias("tile"),
        )
        cols = points.select(F.col("centroid_id").alias("target"), "x", "y", (F.col("other") * self.side + F.col("own")).alias("tile"))
        value = G.distance(F.col("ox"), F.col("oy"), F.col("x"), F.col("y"))
        both = self.dealt(rows).join(self.dealt(cols).hint("shuffle_hash"), "tile")
        return both.select("tile", "origin", "target", value.alias("value"))

    def of_pairs(self, matrix: DataFrame) -> DataFrame:
        """Pairs of a matrix with their tile."""
        return matrix.withColumn("tile", self.block("origin") * self.side + self.block("target"))


def crow_fly(near: DataFrame) -> DataFrame:
    """origin, target, value: straight distance between all pairs of snapped points.

    The full matrix has a row per pair by definition.  It is made tile by tile:
    both axes are cut into blocks, and each block pair is one join key, so work
    per task is bounded and neither axis is broadcast.
    """
    return Tiles(near).pairs(near).drop("tile")


def with_crow(matrix: DataFrame, near: DataFrame) -> DataFrame:
    """The matrix rows with ``crow``: the straight distance of the same pair."""
    a = near.select(
        F.col("centroid_id").alias("origin"), F.col("x").alias("ox"), F.col("y").alias("oy")
    )
    b = near.select(F.col("centroid_id").alias("target"), "x", "y")
    crow = G.distance(F.col("ox"), F.col("oy"), F.col("x"), F.col("y"))
    return (
        matrix.join(a, "origin").join(b, "target").select("origin", "target", "value", crow.alias("crow"))
    )


def ratios(matrix: DataFrame, near: DataFrame) -> DataFrame:
    """Network over straight distance; pairs without a ratio (0 / 0) are left out."""
    ratio = F.try_divide(F.col("value"), F.col("crow")).alias("ratio")
    both = with_crow(matrix, near).select("origin", "target", ratio)
    return both.filter(F.col("ratio").isNotNull())


def wiggle_factor(matrix: DataFrame, near: DataFrame, strict: bool = True) -> DataFrame:
    """One row: the mean ratio; a least ratio below 1 raises unless not strict."""
    got = ratios(matrix, near).agg(F.avg("ratio").alias("factor"), F.min("ratio").alias("low"))
    if not strict:
        return got
    wrong = F.raise_error(F.lit("a network distance is shorter than the straight line"))
    return got.select(
        F.when(F.col("low") < 1, wrong.cast("double")).otherwise(F.col("factor")).alias("factor"), "low"
    )


def ratio_summary(matrix: DataFrame, near: DataFrame) -> DataFrame:
    """One row: mean, median, min and max of the ratio."""
    rows = ratios(matrix, near)
    ends = rows.agg(
        F.avg("ratio").alias("mean"), F.min("ratio").alias("min"), F.max("ratio").alias("max")
    )
    middle = quantiles(rows, "ratio", ["origin", "target"], {"median": 0.5})
    return _side_by_side(ends, middle)


def largest_ratios(matrix: DataFrame, near: DataFrame, n: int = 5) -> DataFrame:
    """The n pairs of different centroids with the largest ratio, one row per pair."""
    rows = ratios(matrix, near).filter(F.col("origin") != F.col("target"))
    first = F.min(F.struct("origin", "target", "ratio")).alias("b")
    return (
        rows.groupBy(F.least("origin", "target").alias("lo"), F.greatest("origin", "target").alias("hi"))
        .agg(first)
        .select("b.*")
        .orderBy(F.desc("ratio"), "origin", "target")
        .limit(n)
    )


def symmetry(matrix: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """One row: the largest difference between the two directions of a pair, and how
    many pairs differ by more than the tolerance.  Sums run in opposite order on the
    way back, so the last digits may differ."""
    value = F.col("value")
    pair = matrix.groupBy(
        F.least("origin", "target").alias("lo"), F.greatest("origin", "target").alias("hi")
    ).agg(
        F.max(F.when(F.col("origin") < F.col("target"), value)).alias("there"),
        F.max(F.when(F.col("origin") > F.col("target"), value)).alias("back"),
    )
    diff = F.col("there") - F.col("back")
    return pair.agg(
        F.coalesce(F.max(F.abs(diff)), F.lit(0.0)).alias("max_abs_diff"),
        F.count(F.when(F.abs(diff) > tolerance, 1)).alias("asymmetric_pairs"),
    )


def combined(matrix: DataFrame, near: DataFrame, factor: DataFrame, written: bool = True) -> DataFrame:
    """Every pair: the network cost, or straight distance times the factor.  Written, or
    with ``written`` off made anew by whatever reads it: n² rows that are only counted
    or summed need not lie on disk.

    The rows of the full matrix stay where their tile was made; only the network rows
    are sent there.  For that Spark may take rows that are together by tile as being
    together by (tile, origin, target) too (see :func:`summary`).
    """
    full = _filled(matrix, near, factor)
    return summary(full, "combined") if written else full


def summary(df: DataFrame, name: str) -> DataFrame:
    """``df`` written, by a plan in which the rows of a full matrix stay in their tiles."""
    with setting(df.sparkSession, TOGETHER_BY_SOME_KEYS, "false"), setting(df.sparkSession, CLEAN, "true"):
        return materialise(df, name)


def _filled(matrix: DataFrame, near: DataFrame, factor: DataFrame) -> DataFrame:
    tiles = Tiles(near)
    full = tiles.pairs(near).withColumnRenamed("value", "crow")
    # the known costs of a tile are looked up, so that its pairs need not be sorted
    known = tiles.dealt(tiles.of_pairs(matrix)).hint("shuffle_hash")
    number = factor.select("factor").scalar()
    return full.join(known, ["tile", "origin", "target"], "left").select(
        "origin",
        "target",
        F.coalesce(F.col("value"), F.col("crow") * number).alias("value"),
        F.col("value").isNotNull().alias("from_network"),
    )


def network_cells(full: DataFrame) -> DataFrame:
    """The network matrix over every pair, empty where there is no network cost."""
    value = F.when(F.col("from_network"), F.col("value")).alias("value")
    return full.select("origin", "target", value)


def diagonal(matrix: DataFrame) -> DataFrame:
    own = matrix.filter(F.col("origin") == F.col("target"))
    got = own.agg(
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("diagonal_sum"), F.count(F.lit(1)).alias("n")
    )
    return summary(got, "diagonal")


def bin_counts(matrix: DataFrame) -> DataFrame:
    """position, bin, count for all seven bins, empty ones included.

    One pass with a conditional count per bin; no join to a label list is needed.
    """
    labels = [label for _, label in COST_BINS] + [COST_BIN_LAST]
    got = matrix.select(cost_bin(F.col("value")).alias("bin")).agg(
        *[F.count(F.when(F.col("bin") == label, 1)).alias(f"b{i}") for i, label in enumerate(labels)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(label).alias("bin"), F.col(f"b{i}").alias("count"))
            for i, label in enumerate(labels)
        ]
    )
    return summary(got, "bins").select(F.explode(rows).alias("r")).select("r.*")


def describe(matrix: DataFrame) -> DataFrame:
    """One row: count, mean, std, min, quartiles and max of the values (metres)."""
    ends = matrix.agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    ends = summary(ends, "ends")
    with setting(matrix.sparkSession, TOGETHER_BY_SOME_KEYS, "false"), setting(matrix.sparkSession, CLEAN, "true"):
        mid = counted_quantiles(matrix, "value", ["origin", "target"], probs, ends.first())
    return _side_by_side(ends, mid)


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row tables as one row."""
    return a.withColumn("_k", F.lit(0)).join(b.withColumn("_k", F.lit(0)), "_k").drop("_k")


def to_km(matrix: DataFrame) -> DataFrame:
    return matrix.select("origin", "target", (F.col("value") / 1000).alias("value_km"))


def wide_rows(matrix: DataFrame, value: str = "value") -> DataFrame:
    """One row per origin: its (target, value) cells in order of target."""
    cells = F.array_sort(F.collect_list(F.struct("target", F.col(value).alias("value"))))
    return matrix.groupBy("origin").agg(cells.alias("cells"))


def stack(wide: DataFrame) -> DataFrame:
    """The long form of :func:`wide_rows`."""
    return wide.select("origin", F.explode("cells").alias("c")).select("origin", "c.*")


def comparison(matrix: DataFrame, near: DataFrame, width_m: float = 500.0) -> DataFrame:
    """Counts of pairs by class of straight and of network distance."""
    return (
        with_crow(matrix, near)
        .groupBy(
            F.floor(F.col("crow") / width_m).alias("crow_class"),
            F.floor(F.col("value") / width_m).alias("network_class"),
        )
        .agg(F.count(F.lit(1)).alias("pairs"))
    )


def comparison_lines(matrix: DataFrame, near: DataFrame) -> DataFrame:
    """End points of the 1:1 line and of the factor line of the comparison."""
    rows = with_crow(matrix, near)
    ratio = F.try_divide(F.col("value"), F.col("crow"))
    got = rows.agg(F.max("crow").alias("max_crow"), F.avg(ratio).alias("factor"))
    return got.select("max_crow", "factor", (F.col("max_crow") * F.col("factor")).alias("factor_end"))


def desire_lines(od: DataFrame, near: DataFrame) -> DataFrame:
    """One line per pair of centroids, with the band of its cost."""
    p1 = near.select(F.col("centroid_id").alias("start_centroid"), F.struct("x", "y").alias("p1"))
    p2 = near.select(F.col("centroid_id").alias("target_centroid"), F.struct("x", "y").alias("p2"))
    return (
        od.select("start_centroid", "target_centroid", "agg_cost")
        .join(p1, "start_centroid")
        .join(p2, "target_centroid")
        .select(
            "start_centroid",
            "target_centroid",
            F.array("p1", "p2").alias("pts"),
            distance_band(F.col("agg_cost")).alias("dist_band"),
        )
    )


def check_table(matrix: DataFrame, network: DataFrame, near: DataFrame) -> DataFrame:
    """name, value, level for every check of the matrix job."""
    low = ratios(network, near).agg(F.min("ratio").alias("v"))

    def row(frame: DataFrame, name: str, value: Column, bad: Column, level: str) -> DataFrame:
        return frame.select(
            F.lit(name).alias("name"),
            value.cast("double").alias("value"),
            F.when(bad, level).otherwise("ok").alias("level"),
        )

    sym = symmetry(network)
    return (
        row(low, "least ratio", F.col("v"), F.col("v") < 1, "error")
        .unionByName(
            row(sym, "asymmetric pairs", F.col("asymmetric_pairs"), F.col("asymmetric_pairs") > 0, "warning")
        )
        .unionByName(
            row(diagonal(matrix), "diagonal", F.col("diagonal_sum"), F.col("diagonal_sum") != 0, "warning")
        )
    )


def missing_centroids(zones: DataFrame, centroids: DataFrame, zone_key: str, key: str) -> DataFrame:
    """Zones that no centroid names."""
    return zones.join(centroids.select(F.col(key).alias(zone_key)), zone_key, "left_anti")


def local_centroids(zones: DataFrame, centroids: DataFrame, zone_key: str, key: str) -> DataFrame:
    """Centroids of the given zones, with the zone's columns but its shape."""
    keep = [c for c in zones.columns if c != "rings"]
    return centroids.join(zones.select(*keep), F.col(key) == F.col(zone_key))
