"""From delivered road, stop and address tables to routable tables tagged with zones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathloom.functions import geom as G
from pathloom.functions import text as T
from pathloom.operators import cells as C
from pathloom.operators.ranks import numbered
from pathloom.session import materialise
from pathloom.sources.network import ATTRIBUTES


def edge_table(raw: DataFrame) -> DataFrame:
    """One row per link: ends, geodesic length, costs by direction, grid line."""
    length = G.geodesic_length(F.col("pts")).alias("length")
    base = raw.select(
        F.col("wayid").alias("id"),
        *ATTRIBUTES,
        T.first_node(F.col("nodes")).alias("source"),
        T.last_node(F.col("nodes")).alias("target"),
        length,
        G.project_line(F.col("pts")).alias("pts"),
    )
    one, metres = F.col("oneway"), F.col("length")
    return base.withColumns(
        {"cost": T.forward_cost(one, metres), "reverse_cost": T.backward_cost(one, metres)}
    )


def grid_points(raw: DataFrame, *keep: str) -> DataFrame:
    """Kept columns with x, y on the grid; ``raw`` holds x, y in degrees."""
    at = raw.select(*keep, G.to_grid(F.col("x"), F.col("y")).alias("g"))
    return at.select(*keep, F.col("g.x").alias("x"), F.col("g.y").alias("y"))


def node_zones(nodes: DataFrame, zones: DataFrame) -> DataFrame:
    return C.points_in_zones(nodes, zones, ["lsoa21cd"])


def edge_zones(edges: DataFrame, zones: DataFrame) -> DataFrame:
    """rowid, id, lsoa21cd, lsoa21nm, segment_length: the stretch of each link in each
    zone.  Zones are told apart by code; two may have one name."""
    part = C.line_zone_overlap(edges, zones, "id", ["lsoa21cd", "lsoa21nm"])
    return numbered(part, ["id", "lsoa21cd"], name="rowid")[0]


def longest_zones(parts: DataFrame) -> DataFrame:
    """The zone with the longest stretch of each link; ties are kept."""
    longest = F.rank().over(Window.partitionBy("id").orderBy(F.desc("segment_length")))
    return parts.withColumn("k", longest).filter("k = 1").select("id", "rowid", "lsoa21nm")


@dataclass(frozen=True)
class Prepared:
    """Tables of one run, on the grid and tagged with zones."""

    edges: DataFrame
    nodes: DataFrame
    edge_zones: DataFrame
    main_zones: DataFrame
    addresses: DataFrame
    lanes: DataFrame


def prepare(
    raw_links: DataFrame, raw_nodes: DataFrame, raw_addresses: DataFrame, lanes: DataFrame, zones: DataFrame
) -> Prepared:
    """The whole preparation: links, nodes and addresses in degrees and bus lanes as
    text become routable tables; ``zones`` is on the grid already."""
    edges = materialise(edge_table(raw_links), "edges")
    parts = materialise(edge_zones(edges, zones), "edge_zones")
    nodes = node_zones(grid_points(raw_nodes, "nodeid"), zones)
    homes = address_zones(grid_points(raw_addresses, "uprn", "class"), zones)
    lines = bus_lane_lines(lanes).withColumn("pts", G.project_line(F.col("pts")))
    return Prepared(edges, nodes, parts, longest_zones(parts), homes, lines)


def bus_lane_lines(lanes: DataFrame) -> DataFrame:
    """osid and the line held as text in the bus lane file."""
    return lanes.select("osid", G.parse_text(F.col("geometry")).alias("pts"))


def address_zones(addresses: DataFrame, zones: DataFrame) -> DataFrame:
    """Addresses of homes and businesses with their zone."""
    kept = addresses.filter(F.substring("class", 1, 1).isin("R", "C"))
    return C.points_in_zones(kept, zones, ["lsoa21cd", "lsoa21nm"])
