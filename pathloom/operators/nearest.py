"""Nearest neighbour joins without a spatial index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.functions import geom as G
from pathloom.operators.cells import point_rows, points_near_lines
from pathloom.session import materialise


def nearest_nodes(
    points: DataFrame, nodes: DataFrame, key: str = "centroid_id", cell: float = 250.0
) -> DataFrame:
    """key, node_id, dist, x, y (of the node): the nearest node of every point.

    Each point looks at the 3 x 3 cells round it.  A find no farther than one
    cell width is final; the rest try again with cells twice as wide.  Points at
    one place are looked up once.  A point without a place (an empty or endless
    coordinate) is given back with no node; such nodes are left out.
    """
    nodes = nodes.filter(_placed("x", "y"))
    if nodes.isEmpty():
        return points.select(
            key,
            F.lit(None).cast("bigint").alias("node_id"),
            F.lit(None).cast("double").alias("dist"),
            F.lit(None).cast("double").alias("x"),
            F.lit(None).cast("double").alias("y"),
        )
    targets = materialise(
        nodes.select("nodeid", F.col("x").alias("nx"), F.col("y").alias("ny")), "targets"
    )
    lost = points.filter(~_placed("x", "y"))
    open_places = points.filter(_placed("x", "y")).select("x", "y").distinct()
    found = None
    while True:
        tried = materialise(_round(open_places, targets, cell), "nearest")
        done = tried.filter(F.col("dist") <= cell)
        found = done if found is None else found.unionByName(done)
        rest = open_places.join(done.select("x", "y"), ["x", "y"], "left_anti")
        if rest.isEmpty():
            break
        open_places = materialise(rest, "open")
        cell *= 2
    near = points.select(key, "x", "y").join(found, ["x", "y"]).select(
        key, "node_id", "dist", F.col("nx").alias("x"), F.col("ny").alias("y")
    )
    return near.unionByName(lost.select(key), allowMissingColumns=True)


def _placed(*columns: str) -> Column:
    """All coordinates are numbers short of 1e15."""
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.coalesce(F.abs(F.col(c)) < 1e15, F.lit(False))
    return ok


def _round(places: DataFrame, targets: DataFrame, cell: float) -> DataFrame:
    step = F.array(*[F.lit(i).cast("bigint") for i in (-1, 0, 1)])
    around = (
        point_rows(places, cell)
        .withColumn("cx", F.explode(F.transform(step, lambda i: F.col("cx") + i)))
        .withColumn("cy", F.explode(F.transform(step, lambda i: F.col("cy") + i)))
    )
    spots = point_rows(targets.select("nodeid", F.col("nx").alias("x"), F.col("ny").alias("y")), cell)
    spots = spots.select("nodeid", F.col("x").alias("nx"), F.col("y").alias("ny"), "cx", "cy")
    dist = G.distance(F.col("x"), F.col("y"), F.col("nx"), F.col("ny"))
    best = F.min(F.struct(dist.alias("dist"), F.col("nodeid").alias("node_id"), "nx", "ny"))
    return (
        around.join(spots, ["cx", "cy"])
        .groupBy("x", "y")
        .agg(best.alias("b"))
        .select("x", "y", "b.*")
    )


def nearest_link(
    points: DataFrame, links: DataFrame, key: str, within: float = 100.0
) -> DataFrame:
    """key, id, dist: the nearest link within the distance, ties to the least id."""
    best = F.min(F.struct("dist", "id")).alias("b")
    near = points_near_lines(points, links, key, "id", within)
    return near.groupBy(key).agg(best).select(key, "b.id", "b.dist")
