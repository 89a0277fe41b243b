"""Mode filters, node degree and node usability on a link table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Highway classes open to cars, and closed to cycles.
CAR_HIGHWAYS = (
    "motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link",
    "secondary", "secondary_link", "tertiary", "tertiary_link", "unclassified", "residential",
)
NO_BIKE_HIGHWAYS = ("motorway", "motorway_link")

# Distance limit in metres by mode, and the slack put on top of it.
CUTOFF_M = {"foot": 20000, "car": 50000, "bike": 50000}
RADIUS_SLACK = 1.2
MODE_ALIASES = {"walk": "foot", "drive": "car", "cycle": "bike"}


@dataclass(frozen=True)
class Mode:
    name: str
    cutoff_m: float
    radius_m: float

    def usable(self) -> Column:
        """Predicate for the links open to the mode; NULL attributes do not pass."""
        no_rail = F.col("rail") == "no"
        if self.name == "foot":
            return no_rail & (F.col("foot") != "no")
        if self.name == "bike":
            return no_rail & ~F.col("highway").isin(*NO_BIKE_HIGHWAYS)
        return no_rail & F.col("highway").isin(*CAR_HIGHWAYS)


def mode(name: str) -> Mode:
    canonical = MODE_ALIASES.get(name, name)
    if canonical not in CUTOFF_M:
        raise ValueError(f"no such mode of travel: {name!r}")
    cutoff = float(CUTOFF_M[canonical])
    return Mode(canonical, cutoff, cutoff * RADIUS_SLACK)


def for_mode(links: DataFrame, name: str) -> DataFrame:
    return links.filter(mode(name).usable())


def ends(links: DataFrame, *keep: str, loops: bool = True) -> DataFrame:
    """One row per link end: the kept columns, ``node`` and ``end`` (source / target)."""
    rows = links if loops else links.filter(F.col("source") != F.col("target"))
    both = F.array(
        F.struct(F.col("source").alias("node"), F.lit("source").alias("end")),
        F.struct(F.col("target").alias("node"), F.lit("target").alias("end")),
    )
    return rows.select(*keep, F.explode(both).alias("_e")).select(*keep, "_e.*")


def degrees(links: DataFrame, loops: bool = False) -> DataFrame:
    """node, degree: link ends at each node; loop links are left out by default."""
    return ends(links, loops=loops).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def usable_nodes(nodes: DataFrame, usable_links: DataFrame) -> DataFrame:
    """Nodes that are an end of at least one usable link."""
    at = ends(usable_links).select(F.col("node").alias("nodeid")).distinct()
    return nodes.join(at, "nodeid", "left_semi")
