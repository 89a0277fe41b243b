"""Which links of a detailed network belong to the simplified one, zone by zone.

All zones run in one job: every table carries the zone (``zid``).  The steps
add to one set, so each is a semi-join on (zone, name) or (zone, id).

Joins with a row per link are sorted: files of ids and repeated names are so small
that Spark would broadcast all links by their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.functions import geom as G
from pathloom.operators.cells import (
    line_zone_distance,
    lines_meeting,
    points_in_zones,
    points_near_lines,
)
from pathloom.operators.network import ends
from pathloom.session import materialise

# Classes left out at the zone boundary and added inside a zone.
NOT_AT_BOUNDARY = ("footway", "track")
MAIN_HIGHWAYS = ("primary", "trunk", "secondary", "tertiary")

# Distances in metres and the least length of a kept road name.
STOP_M, NAME_M, TAKE_M, MIN_NAME_LENGTH_M = 12.0, 150.0, 50.0, 226.0

# Name patterns that keep a short road out or in.
NAME_OUT = ("%Crescent", "%Grove")
NAME_IN = ("% Road%", "% Roundabout%")
ROUNDABOUT = "% Roundabout%"
NAME_SEPARATOR = "/"


def is_dual(name: Column) -> Column:
    return F.contains(name, F.lit(NAME_SEPARATOR))


def any_like(name: Column, patterns: tuple[str, ...]) -> Column:
    out = name.like(patterns[0])
    for p in patterns[1:]:
        out = out | name.like(p)
    return out


def boundary_links(links: DataFrame, zones: DataFrame) -> DataFrame:
    """zid, id: named roads that meet an outer ring of a zone, whichever its part."""
    roads = links.filter(~F.col("highway").isin(*NOT_AT_BOUNDARY) & F.col("name").isNotNull())
    outer = zones.withColumn("rings", G.outer_rings(F.col("rings")))
    near = line_zone_distance(roads, outer, "id", ["zid"], 0.0)
    return near.filter(F.col("ring_dist") == 0).select("zid", "id").distinct()


def stop_links(links: DataFrame, zones: DataFrame, stops: DataFrame) -> DataFrame:
    """zid, id: roads within reach of a stop that lies in the zone."""
    inside = points_in_zones(stops, zones, ["zid"]).select("stop_id", "zid")
    near = points_near_lines(stops, links, "stop_id", "id", STOP_M)
    return near.join(inside.hint("merge"), "stop_id").select("zid", "id").distinct()


def name_lengths(near: DataFrame, names: DataFrame) -> DataFrame:
    """zid, name, length: total length of the links that carry a selected name."""
    return (
        near.filter(F.col("dist") <= NAME_M)
        .join(names, ["zid", "name"], "left_semi")
        .groupBy("zid", "name")
        .agg(F.sum("length").alias("length"))
    )


def _substrings(text: Column, sizes: Column) -> Column:
    return F.array_distinct(
        F.flatten(
            F.transform(
                sizes,
                lambda n: F.transform(
                    F.when(
                        F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)
                    ).otherwise(F.array().cast("array<int>")),
                    lambda i: F.substring(text, i, n),
                ),
            )
        )
    )


def names_containing(long: DataFrame, short: DataFrame) -> DataFrame:
    """The (zid, long, part) rows where a short name is a part of a long one.

    Both hold distinct (zid, name).  Every substring of a long name whose length
    some short name of the zone has is looked up by equality: exact, and without
    comparing each name with each other.
    """
    sizes = short.groupBy("zid").agg(F.collect_set(F.length("name")).alias("sizes"))
    parts = long.join(sizes, "zid").select(
        "zid",
        F.col("name").alias("long"),
        F.explode(_substrings(F.col("name"), F.col("sizes"))).alias("part"),
    )
    return parts.join(short.withColumnRenamed("name", "part").hint("merge"), ["zid", "part"])


def _names(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("name").isNotNull()).select("zid", "name").distinct()


def touching_links(links: DataFrame, others: DataFrame, by: list[str]) -> DataFrame:
    """by, id, other: the least-id link that touches each link (distance 0)."""
    here = ends(links, *by, "id")
    # The least two per node, so that a link does not have to name itself.
    there = ends(others, *by, "id").groupBy(*by, "node").agg(F.min("id").alias("low"))
    second = (
        ends(others, *by, "id")
        .join(there.hint("merge"), [*by, "node"])
        .filter(F.col("id") != F.col("low"))
        .groupBy(*by, "node")
        .agg(F.min("id").alias("next"))
    )
    at_node = (
        here.join(there, [*by, "node"])
        .join(second, [*by, "node"], "left")
        .select(*by, "id", F.when(F.col("low") != F.col("id"), F.col("low")).otherwise(F.col("next")).alias("other"))
        .filter(F.col("other").isNotNull())
    )
    cols = ["id", "source", "target", "pts"]
    met = lines_meeting(
        links.select(*cols).dropDuplicates(["id"]), others.select(*cols).dropDuplicates(["id"]), "id", "id"
    ).select(F.col("id1").alias("id"), F.col("id2").alias("other"))
    if by:
        met = met.join(links.select(*by, "id").hint("merge"), "id").join(
            others.select(*by, F.col("id").alias("other")).hint("merge"), [*by, "other"]
        )
    both = at_node.unionByName(met.select(*by, "id", "other"))
    return both.groupBy(*by, "id").agg(F.min("other").alias("other"))


def zone_near(links: DataFrame, zones: DataFrame) -> DataFrame:
    """zid, id, dist with the attributes the rules look at, up to the widest distance."""
    near = line_zone_distance(links, zones, "id", ["zid"], NAME_M)
    near = near.groupBy("zid", "id").agg(F.min("dist").alias("dist"))
    return near.join(links.select("id", "name", "highway", "junction", "length").hint("merge"), "id")


def first_links(links: DataFrame, zones: DataFrame, stops: DataFrame) -> DataFrame:
    """zid, id, name: roads over the zone boundary and roads near a stop."""
    found = boundary_links(links, zones).unionByName(stop_links(links, zones, stops)).distinct()
    return found.join(links.select("id", "name").hint("merge"), "id")


def select_links(links: DataFrame, near: DataFrame, first: DataFrame, upto: int = 7) -> DataFrame:
    """zid, id, name, highway, junction: the links each zone selects.

    ``near`` comes from :func:`zone_near` and ``first`` from :func:`first_links`.
    ``upto`` stops after a step (3 names, 4 roads and roundabouts, 5 dual names,
    6 main classes, 7 touching roundabouts).
    """
    cols = ["zid", "id", "name", "highway", "junction"]
    first = materialise(first, "first")
    lengths = materialise(name_lengths(near, _names(first)), "lengths")
    take = near.filter(F.col("dist") <= TAKE_M)

    long_enough = (F.col("length") >= MIN_NAME_LENGTH_M) & ~any_like(F.col("name"), NAME_OUT)
    good = long_enough if upto < 4 else long_enough | any_like(F.col("name"), NAME_IN)
    names = lengths.filter(good).select("zid", "name")
    picked = take.join(names, ["zid", "name"], "left_semi").select(*cols)
    if upto >= 4:
        picked = picked.unionByName(take.filter(F.col("name").like(ROUNDABOUT)).select(*cols))
    if upto >= 5:
        picked = _add_dual(picked, take, _names(first), cols)
    if upto >= 6:
        main = near.filter((F.col("dist") == 0) & F.col("highway").isin(*MAIN_HIGHWAYS))
        picked = picked.unionByName(main.select(*cols))
    picked = materialise(picked.dropDuplicates(["zid", "id"]), "picked")
    if upto >= 7:
        shape = links.select("id", "source", "target", "pts").hint("merge")
        missed = take.filter(F.col("junction") == "roundabout").join(picked.hint("merge"), ["zid", "id"], "left_anti")
        missed = missed.select(*cols).join(shape, "id")
        touch = touching_links(missed, picked.join(shape, "id"), ["zid"])
        picked = picked.unionByName(missed.join(touch, ["zid", "id"], "left_semi").select(*cols))
    return picked


def _add_dual(picked: DataFrame, take: DataFrame, first: DataFrame, cols: list[str]) -> DataFrame:
    """Three passes in order: duals with a boundary name, singles named in a
    selected dual, duals with a selected name."""
    near = _names(take)
    dual, single = near.filter(is_dual(F.col("name"))), near.filter(~is_dual(F.col("name")))

    def links_named(found: DataFrame, column: str, rows: DataFrame = take) -> DataFrame:
        names = found.select("zid", F.col(column).alias("name")).distinct()
        return rows.join(names, ["zid", "name"], "left_semi").select(*cols)

    parts = names_containing(dual, first.filter(~is_dual(F.col("name"))))
    picked = picked.unionByName(links_named(parts, "long"))
    now = materialise(_names(picked), "names")
    parts = names_containing(now.filter(is_dual(F.col("name"))), single)
    picked = picked.unionByName(links_named(parts, "part", take.filter(F.col("highway") != "footway")))
    now = materialise(_names(picked), "names")
    parts = names_containing(dual, now.filter(~is_dual(F.col("name"))))
    return picked.unionByName(links_named(parts, "long"))


def seed_working(links: DataFrame, picked: DataFrame, former: DataFrame) -> DataFrame:
    """The working network: picked links that the former result does not hold
    yet, alone or merged, and the former result itself."""
    ids = picked.select("id").distinct().hint("merge")
    fresh = links.join(ids, "id", "left_semi").withColumn(
        "original_ids", F.array(F.col("id").cast("string"))
    )
    inside = former.select(F.explode("original_ids").alias("m"))
    inside = inside.select(F.col("m").try_cast("bigint").alias("id")).filter(F.col("id").isNotNull())
    seen = former.select("id").unionByName(inside).distinct()
    return fresh.join(seen.hint("merge"), "id", "left_anti").unionByName(former.select(*fresh.columns))
