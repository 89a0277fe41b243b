"""Service areas of the nodes reached within some distances."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.session import ship_functions

ship_functions(__name__)

# Limits in metres of the three service areas.
BANDS_M = (200, 400, 600)


def band_rows(reached: DataFrame, bands: tuple[int, ...] = BANDS_M) -> DataFrame:
    """A row of (origin, band, node, x, y) for every band a node is within."""
    limits = F.array(*[F.lit(b) for b in bands])
    inside = F.filter(limits, lambda b: F.col("agg_cost") <= b)
    return reached.select("origin", "node", "x", "y", F.explode(inside).alias("band"))


def footprint(reached: DataFrame, cell: float = 100.0, bands: tuple[int, ...] = BANDS_M) -> DataFrame:
    """origin, band, nodes, cells, area: grid cells with at least one reached node."""
    per_cell = (
        band_rows(reached, bands)
        .groupBy("origin", "band", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_cell.groupBy("origin", "band").agg(
        F.sum("n").alias("nodes"),
        F.count(F.lit(1)).alias("cells"),
        (F.count(F.lit(1)) * F.lit(cell * cell)).alias("area"),
    )


def outline_sides(reached: DataFrame, cell: float = 100.0, bands: tuple[int, ...] = BANDS_M) -> DataFrame:
    """origin, band, x1, y1, x2, y2: the cell sides (in cells) that bound each footprint.

    A side of two covered cells is inside and cancels out.  A side runs with the covered
    cell on its left, so outer rings run anticlockwise and holes clockwise.
    """
    covered = band_rows(reached, bands).select(
        "origin", "band", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy")
    ).distinct()

    def side(ax: int, ay: int, bx: int, by: int) -> Column:
        ends = {"x1": ("cx", ax), "y1": ("cy", ay), "x2": ("cx", bx), "y2": ("cy", by)}
        return F.struct(*[(F.col(c) + d).alias(n) for n, (c, d) in ends.items()])

    around = F.array(side(0, 0, 1, 0), side(1, 0, 1, 1), side(1, 1, 0, 1), side(0, 1, 0, 0))
    sides = covered.select("origin", "band", F.explode(around).alias("s"))
    a, b = F.struct("s.x1", "s.y1"), F.struct(F.col("s.x2").alias("x1"), F.col("s.y2").alias("y1"))
    once = sides.groupBy("origin", "band", F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).agg(
        F.count(F.lit(1)).alias("n"), F.first("s").alias("s")
    )
    return once.filter("n = 1").select("origin", "band", "s.*")


_OUTLINE = "origin bigint, band int, rings array<array<struct<x:double,y:double>>>, corners int, area double, perimeter double"


def outlines(reached: DataFrame, cell: float = 100.0, bands: tuple[int, ...] = BANDS_M) -> DataFrame:
    """origin, band, rings, corners, area, perimeter: the contour of each footprint, holes
    included; only its own boundary sides meet in one group."""

    def trace(group: pd.DataFrame) -> pd.DataFrame:
        rings = [np.array(r, float) * cell for r in chained(group[["x1", "y1", "x2", "y2"]].to_numpy())]
        area, length = 0.0, 0.0
        for r in rings:
            after = np.roll(r, -1, axis=0)
            area += float((r[:, 0] * after[:, 1] - r[:, 1] * after[:, 0]).sum()) / 2
            length += float(np.abs(after - r).sum())
        closed = [[{"x": float(x), "y": float(y)} for x, y in [*r, r[0]]] for r in rings]
        row = {"origin": group["origin"].iloc[0], "band": group["band"].iloc[0], "rings": closed}
        return pd.DataFrame([{**row, "corners": sum(map(len, rings)), "area": area, "perimeter": length}])

    return outline_sides(reached, cell, bands).groupBy("origin", "band").applyInPandas(trace, _OUTLINE)


def chained(sides: np.ndarray) -> list[list[tuple[int, int]]]:
    """Corners of the rings that directed unit sides make.  Where two rings touch at a
    corner the sharper left turn is taken, so that cells met only there stay apart."""
    ahead: dict[tuple, list] = {}
    for x1, y1, x2, y2 in sides[np.lexsort(sides.T[::-1])].tolist():
        ahead.setdefault((x1, y1), []).append((x2, y2))
    rings = []
    while ahead:
        first = at = min(ahead)
        step, ring = None, []
        while True:
            ways = ahead[at]
            if step is not None and len(ways) > 1:
                ways.sort(key=lambda to: step[0] * (to[1] - at[1]) - step[1] * (to[0] - at[0]))
            to = ways.pop()
            if not ways:
                del ahead[at]
            new = (to[0] - at[0], to[1] - at[1])
            if new != step:
                ring.append(at)
            at, step = to, new
            if at == first and (at not in ahead or len(ring) > 2):
                break
        rings.append(ring)
    return rings


def hulls(reached: DataFrame, bands: tuple[int, ...] = BANDS_M, strip: float = 250.0) -> DataFrame:
    """origin, band, corners, area, pts: the convex hull of each service area.

    The hull of hulls is the hull: points are first thinned to the least and
    greatest y per x, then to the hull of each strip of the plane, and only
    those corners meet in one group.
    """
    rows = band_rows(reached, bands)
    edge = rows.groupBy("origin", "band", "x").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    thin = edge.select(
        "origin",
        "band",
        F.floor(F.col("x") / strip).alias("strip"),
        "x",
        F.explode(F.array_distinct(F.array("lo", "hi"))).alias("y"),
    )
    corners = thin.groupBy("origin", "band", "strip").applyInPandas(
        _corners, "origin bigint, band int, x double, y double"
    )
    return corners.groupBy("origin", "band").applyInPandas(
        _outline, "origin bigint, band int, corners int, area double, pts array<struct<x:double,y:double>>"
    )


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, anticlockwise, without points on its sides."""
    pts = np.unique(points, axis=0)
    if len(pts) < 3:
        return pts

    def half(rows: np.ndarray) -> list:
        out: list = []
        for p in rows:
            while len(out) > 1:
                (ax, ay), (bx, by) = out[-2], out[-1]
                if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0:
                    break
                out.pop()
            out.append(tuple(p))
        return out[:-1]

    return np.array(half(pts) + half(pts[::-1]))


def _corners(group: pd.DataFrame) -> pd.DataFrame:
    corner = hull(group[["x", "y"]].to_numpy())
    return pd.DataFrame(
        {"origin": group["origin"].iloc[0], "band": group["band"].iloc[0], "x": corner[:, 0], "y": corner[:, 1]}
    )


def _outline(group: pd.DataFrame) -> pd.DataFrame:
    corner = hull(group[["x", "y"]].to_numpy())
    x, y = corner[:, 0], corner[:, 1]
    area = abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2
    pts = [{"x": float(a), "y": float(b)} for a, b in corner]
    return pd.DataFrame(
        {
            "origin": [group["origin"].iloc[0]],
            "band": [group["band"].iloc[0]],
            "corners": [len(corner)],
            "area": [float(area)],
            "pts": [pts],
        }
    )
