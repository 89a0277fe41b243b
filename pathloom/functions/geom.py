"""Planar and geodetic geometry as column expressions.

A line is ``ARRAY<STRUCT<x, y>>``; a polygon is a list of closed rings and is
tested through its list of edges ``ARRAY<STRUCT<x1, y1, x2, y2>>``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind a value once and use it several times in one expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


# ---- points and segments --------------------------------------------------


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def along(px, py, x1, y1, x2, y2) -> Column:
    """Position (0 to 1) on the segment that is nearest to the point."""
    dx, dy = x2 - x1, y2 - y1
    t = F.try_divide((px - x1) * dx + (py - y1) * dy, dx * dx + dy * dy)
    return F.least(F.greatest(F.coalesce(t, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def point_segment(px, py, x1, y1, x2, y2) -> Column:
    t = along(px, py, x1, y1, x2, y2)
    qx, qy = x1 + t * (x2 - x1), y1 + t * (y2 - y1)
    return distance(px, py, qx, qy)


def side(ax, ay, bx, by, px, py) -> Column:
    """Positive if p lies to the left of a → b, zero if it lies on that line."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def _within(px, py, x1, y1, x2, y2) -> Column:
    return px.between(F.least(x1, x2), F.greatest(x1, x2)) & py.between(
        F.least(y1, y2), F.greatest(y1, y2)
    )


def segments_meet(a1, b1, a2, b2, c1, d1, c2, d2) -> Column:
    """Segments (a1,b1)-(a2,b2) and (c1,d1)-(c2,d2) share at least one point."""
    s1, s2 = side(a1, b1, a2, b2, c1, d1), side(a1, b1, a2, b2, c2, d2)
    s3, s4 = side(c1, d1, c2, d2, a1, b1), side(c1, d1, c2, d2, a2, b2)
    proper = (F.signum(s1) * F.signum(s2) < 0) & (F.signum(s3) * F.signum(s4) < 0)
    touch = (
        ((s1 == 0) & _within(c1, d1, a1, b1, a2, b2))
        | ((s2 == 0) & _within(c2, d2, a1, b1, a2, b2))
        | ((s3 == 0) & _within(a1, b1, c1, d1, c2, d2))
        | ((s4 == 0) & _within(a2, b2, c1, d1, c2, d2))
    )
    return proper | touch


def segment_distance(a1, b1, a2, b2, c1, d1, c2, d2) -> Column:
    apart = F.least(
        point_segment(a1, b1, c1, d1, c2, d2),
        point_segment(a2, b2, c1, d1, c2, d2),
        point_segment(c1, d1, a1, b1, a2, b2),
        point_segment(c2, d2, a1, b1, a2, b2),
    )
    return F.when(segments_meet(a1, b1, a2, b2, c1, d1, c2, d2), F.lit(0.0)).otherwise(apart)


def crossing_at(a1, b1, a2, b2, c1, d1, c2, d2) -> Column:
    """Position on the first segment where the second crosses it; NULL if it does not."""
    det = (a2 - a1) * (d2 - d1) - (b2 - b1) * (c2 - c1)
    t = F.try_divide((c1 - a1) * (d2 - d1) - (d1 - b1) * (c2 - c1), det)
    u = F.try_divide((c1 - a1) * (b2 - b1) - (d1 - b1) * (a2 - a1), det)
    return F.when(t.between(0.0, 1.0) & u.between(0.0, 1.0), t)


def meeting_point(a1, b1, a2, b2, c1, d1, c2, d2) -> Column:
    """A point that two meeting segments share: their crossing or, where they run
    along each other, the least end of one that lies on the other."""
    t = crossing_at(a1, b1, a2, b2, c1, d1, c2, d2)

    def shared(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
        on = (side(x1, y1, x2, y2, px, py) == 0) & _within(px, py, x1, y1, x2, y2)
        return F.when(on, point(px, py))

    ends = F.least(
        shared(a1, b1, c1, d1, c2, d2),
        shared(a2, b2, c1, d1, c2, d2),
        shared(c1, d1, a1, b1, a2, b2),
        shared(c2, d2, a1, b1, a2, b2),
    )
    crossing = point(a1 + t * (a2 - a1), b1 + t * (b2 - b1))
    return F.when(t.isNotNull(), crossing).otherwise(ends)


# ---- lines ------------------------------------------------------------------


def line_start(pts: Column) -> Column:
    return F.element_at(pts, 1)


def line_end(pts: Column) -> Column:
    return F.element_at(pts, -1)


def pairs(pts: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of each entry of an array and the next one."""
    n = F.greatest(F.size(pts) - 1, F.lit(0))
    return F.zip_with(F.slice(pts, F.lit(1), n), F.slice(pts, F.lit(2), n), use)


def line_edges(pts: Column) -> Column:
    return pairs(
        pts,
        lambda p, q: F.struct(
            p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")
        ),
    )


def line_length(pts: Column) -> Column:
    parts = pairs(pts, lambda p, q: distance(p["x"], p["y"], q["x"], q["y"]))
    return F.aggregate(parts, F.lit(0.0), lambda a, v: a + v)


def point_line(px: Column, py: Column, pts: Column) -> Column:
    """Distance from a point to a line of at least two points."""
    return F.array_min(
        F.transform(
            line_edges(pts), lambda e: point_segment(px, py, e["x1"], e["y1"], e["x2"], e["y2"])
        )
    )


def locate(px: Column, py: Column, pts: Column) -> Column:
    """Nearest place on the line: (dist, seg from 0, t within the segment, x, y)."""
    return F.array_min(
        F.transform(
            line_edges(pts),
            lambda e, i: let(
                along(px, py, e["x1"], e["y1"], e["x2"], e["y2"]),
                lambda t: let(
                    point(e["x1"] + t * (e["x2"] - e["x1"]), e["y1"] + t * (e["y2"] - e["y1"])),
                    lambda q: F.struct(
                        distance(px, py, q["x"], q["y"]).alias("dist"),
                        i.alias("seg"),
                        t.alias("t"),
                        q["x"].alias("x"),
                        q["y"].alias("y"),
                    ),
                ),
            ),
        )
    )


def measure(pts: Column, at: Column) -> Column:
    """Length of the line up to a place given by :func:`locate`."""
    before = line_length(F.slice(pts, F.lit(1), at["seg"] + 1))
    last = F.element_at(pts, at["seg"] + 1)
    return before + distance(last["x"], last["y"], at["x"], at["y"])


def part_before(pts: Column, at: Column) -> Column:
    here = F.array(point(at["x"], at["y"]))
    return F.concat(F.slice(pts, F.lit(1), at["seg"] + 1), here)


def part_after(pts: Column, at: Column) -> Column:
    here = F.array(point(at["x"], at["y"]))
    return F.concat(here, F.slice(pts, at["seg"] + 2, F.size(pts)))


def lengthen(ax: Column, ay: Column, bx: Column, by: Column, by_m: float) -> Column:
    """Line a → b carried on by some metres at its end, as the reference end point."""
    scale = F.coalesce(F.try_divide(F.lit(by_m), distance(ax, ay, bx, by)), F.lit(0.0))
    return F.array(
        point(ax, ay),
        point(bx + (bx - ax) * scale, by + (by - ay) * scale),
    )


def chain_lines(parts: Column) -> Column:
    """Join ordered, end-to-end lines into one, without doubled joints."""
    first = F.element_at(parts, 1)
    rest = F.transform(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: F.slice(p, F.lit(2), F.size(p)),
    )
    return F.concat(first, F.flatten(rest))


# ---- polygons -----------------------------------------------------------------


def polygon_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, line_edges))


def encloses(px: Column, py: Column, edges: Column) -> Column:
    """A ray from the point crosses the edges an odd number of times."""

    def crosses(e: Column) -> Column:
        lean = (px - e["x1"]) * (e["y2"] - e["y1"]) - (e["x2"] - e["x1"]) * (py - e["y1"])
        spans = (e["y1"] > py) != (e["y2"] > py)
        return F.when(spans & ((lean < 0) == (e["y2"] > e["y1"])), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), lambda n, e: n + crosses(e)) % 2 == 1


def outer_rings(rings: Column) -> Column:
    """The rings that are no holes: their first point lies in an even number of the
    others.  A polygon may have several parts."""

    def is_outer(r: Column) -> Column:
        others = polygon_edges(F.filter(rings, lambda q: q != r))
        return ~encloses(r[0]["x"], r[0]["y"], others)

    return F.filter(rings, is_outer)


def on_segment(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The point lies on the segment, ends included."""
    return (side(x1, y1, x2, y2, px, py) == 0) & _within(px, py, x1, y1, x2, y2)


def inside(px: Column, py: Column, edges: Column) -> Column:
    """Point in polygon by ray casting; the boundary belongs to the polygon."""

    def on(e: Column) -> Column:
        return on_segment(px, py, e["x1"], e["y1"], e["x2"], e["y2"])

    return encloses(px, py, edges) | F.exists(edges, on)


def point_polygon(px: Column, py: Column, edges: Column) -> Column:
    near = F.array_min(
        F.transform(edges, lambda e: point_segment(px, py, e["x1"], e["y1"], e["x2"], e["y2"]))
    )
    return F.when(inside(px, py, edges), F.lit(0.0)).otherwise(near)


def segment_ring(x1, y1, x2, y2, edges: Column) -> Column:
    """Distance from a segment to the boundary of a polygon."""
    return F.array_min(
        F.transform(
            edges, lambda e: segment_distance(x1, y1, x2, y2, e["x1"], e["y1"], e["x2"], e["y2"])
        )
    )


def box_of(pts: Column) -> Column:
    """Envelope (x0, y0, x1, y1) of a list of points."""
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x0"),
        F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"),
        F.array_max(ys).alias("y1"),
    )


def box_edges(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    ring = F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))
    return line_edges(ring)


def segment_in_box(x1, y1, x2, y2, bx0, by0, bx1, by1) -> Column:
    """The segment and the closed box share a point (range of t kept by each side)."""
    dx, dy = x2 - x1, y2 - y1

    def span(lo: Column, hi: Column, start: Column, step: Column) -> tuple[Column, Column]:
        a, b = F.try_divide(lo - start, step), F.try_divide(hi - start, step)
        flat_in = (step == 0) & start.between(lo, hi)
        low = F.when(flat_in, 0.0).otherwise(F.least(a, b))
        return low, F.when(flat_in, 1.0).otherwise(F.greatest(a, b))

    x_in, x_out = span(bx0, bx1, x1, dx)
    y_in, y_out = span(by0, by1, y1, dy)
    ok = F.greatest(x_in, y_in, F.lit(0.0)) <= F.least(x_out, y_out, F.lit(1.0))
    flat_off = ((dx == 0) & ~x1.between(bx0, bx1)) | ((dy == 0) & ~y1.between(by0, by1))
    return ok & ~flat_off


# ---- degrees, metres and the national grid --------------------------------------

# WGS 84 ellipsoid (semi-major axis, flattening).
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563

# Airy 1830 ellipsoid, the National Grid projection, and the
# seven-parameter shift from WGS 84 (metres, parts per million, arc seconds).
AIRY_A, AIRY_B = 6377563.396, 6356256.909
GRID_SCALE, GRID_LAT, GRID_LON = 0.9996012717, 49.0, -2.0
GRID_EAST, GRID_NORTH = 400000.0, -100000.0
SHIFT_M = (-446.448, 125.157, -542.060)
SHIFT_PPM = 20.4894
SHIFT_SEC = (-0.1502, -0.2470, -0.8421)


def geodesic(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Length on the WGS 84 ellipsoid by Lambert's formula for long lines."""
    flat = WGS84_F

    def reduced(lat: Column) -> Column:
        return F.atan((1 - flat) * F.tan(F.radians(lat)))

    def length(b: Column) -> Column:
        b1, b2, half = b["b1"], b["b2"], b["half"]
        p, q = (b1 + b2) / 2, (b2 - b1) / 2
        hav = F.pow(F.sin(q), F.lit(2)) + F.cos(b1) * F.cos(b2) * F.pow(F.sin(half), F.lit(2))
        arc = 2 * F.asin(F.least(F.sqrt(hav), F.lit(1.0)))

        def corrected(s: Column) -> Column:
            sin_p, cos_p, sin_q, cos_q = F.sin(p), F.cos(p), F.sin(q), F.cos(q)
            cos_h, sin_h = F.cos(s / 2), F.sin(s / 2)
            x = (s - F.sin(s)) * F.try_divide(sin_p * sin_p * cos_q * cos_q, cos_h * cos_h)
            y = (s + F.sin(s)) * F.try_divide(cos_p * cos_p * sin_q * sin_q, sin_h * sin_h)
            return WGS84_A * (s - flat / 2 * (F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0))))

        return let(arc, corrected)

    start = F.struct(
        reduced(lat1).alias("b1"), reduced(lat2).alias("b2"), F.radians((lon2 - lon1) / 2).alias("half")
    )
    return let(start, length)


def geodesic_length(pts: Column) -> Column:
    parts = pairs(pts, lambda p, q: geodesic(p["x"], p["y"], q["x"], q["y"]))
    return F.aggregate(parts, F.lit(0.0), lambda a, v: a + v)


def to_grid(lon: Column, lat: Column) -> Column:
    """National Grid (x, y) in metres of a WGS 84 position, good to a few metres."""
    return let(_airy(lon, lat), lambda p: _project(p["lat"], p["lon"]))


def _airy(lon: Column, lat: Column) -> Column:
    """Latitude and longitude (radians) on the Airy ellipsoid."""
    e2 = WGS84_F * (2 - WGS84_F)
    rx, ry, rz = (math.radians(s / 3600) for s in SHIFT_SEC)
    grow = 1 + SHIFT_PPM * 1e-6
    airy_e2 = 1 - (AIRY_B / AIRY_A) ** 2
    second = (AIRY_A / AIRY_B) ** 2 - 1

    def cartesian(r: Column) -> Column:
        nu = WGS84_A / F.sqrt(1 - e2 * F.pow(F.sin(r["lat"]), F.lit(2)))
        return F.struct(
            (nu * F.cos(r["lat"]) * F.cos(r["lon"])).alias("x"),
            (nu * F.cos(r["lat"]) * F.sin(r["lon"])).alias("y"),
            (nu * (1 - e2) * F.sin(r["lat"])).alias("z"),
        )

    def shifted(c: Column) -> Column:
        x, y, z = c["x"], c["y"], c["z"]
        return F.struct(
            (SHIFT_M[0] + grow * x - rz * y + ry * z).alias("x"),
            (SHIFT_M[1] + rz * x + grow * y - rx * z).alias("y"),
            (SHIFT_M[2] - ry * x + rx * y + grow * z).alias("z"),
        )

    def back(c: Column) -> Column:
        across = F.sqrt(c["x"] * c["x"] + c["y"] * c["y"])
        turn = F.atan2(c["z"] * AIRY_A, across * AIRY_B)
        lat_out = F.atan2(
            c["z"] + second * AIRY_B * F.pow(F.sin(turn), F.lit(3)),
            across - airy_e2 * AIRY_A * F.pow(F.cos(turn), F.lit(3)),
        )
        return F.struct(lat_out.alias("lat"), F.atan2(c["y"], c["x"]).alias("lon"))

    start = F.struct(F.radians(lat).alias("lat"), F.radians(lon).alias("lon"))
    return let(start, lambda r: let(cartesian(r), lambda c: let(shifted(c), back)))


def _project(lat: Column, lon: Column) -> Column:
    """Transverse Mercator on the Airy ellipsoid, as published for the grid."""
    lat0, lon0 = math.radians(GRID_LAT), math.radians(GRID_LON)
    e2 = 1 - (AIRY_B / AIRY_A) ** 2
    n = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)
    m0 = 1 + n + 1.25 * n**2 + 1.25 * n**3
    m1 = 3 * n + 3 * n**2 + 2.625 * n**3
    m2 = 1.875 * n**2 + 1.875 * n**3
    m3 = 35 / 24 * n**3

    def terms(p: Column) -> Column:
        s2 = F.sin(p) * F.sin(p)
        nu = AIRY_A * GRID_SCALE / F.sqrt(1 - e2 * s2)
        rho = AIRY_A * GRID_SCALE * (1 - e2) / F.pow(1 - e2 * s2, F.lit(1.5))
        arc = (
            m0 * (p - lat0)
            - m1 * F.sin(p - lat0) * F.cos(p + lat0)
            + m2 * F.sin(2 * (p - lat0)) * F.cos(2 * (p + lat0))
            - m3 * F.sin(3 * (p - lat0)) * F.cos(3 * (p + lat0))
        )
        return F.struct(
            nu.alias("nu"),
            (nu / rho).alias("k"),
            (AIRY_B * GRID_SCALE * arc).alias("m"),
            F.sin(p).alias("s"),
            F.cos(p).alias("c"),
            (F.tan(p) * F.tan(p)).alias("t2"),
            (lon - lon0).alias("d"),
        )

    def grid(v: Column) -> Column:
        nu, k, s, c, t2, d = (v[f] for f in ("nu", "k", "s", "c", "t2", "d"))
        eta2 = k - 1
        north = (
            v["m"]
            + GRID_NORTH
            + nu / 2 * s * c * d * d
            + nu / 24 * s * c * c * c * (5 - t2 + 9 * eta2) * F.pow(d, F.lit(4))
            + nu / 720 * s * F.pow(c, F.lit(5)) * (61 - 58 * t2 + t2 * t2) * F.pow(d, F.lit(6))
        )
        east = (
            GRID_EAST
            + nu * c * d
            + nu / 6 * c * c * c * (k - t2) * F.pow(d, F.lit(3))
            + nu
            / 120
            * F.pow(c, F.lit(5))
            * (5 - 18 * t2 + t2 * t2 + 14 * eta2 - 58 * t2 * eta2)
            * F.pow(d, F.lit(5))
        )
        return point(east, north)

    return let(terms(lat), grid)


def project_line(pts: Column) -> Column:
    return F.transform(pts, lambda p: to_grid(p["x"], p["y"]))


# ---- text form -------------------------------------------------------------------


def number_text(v: Column) -> Column:
    """Shortest digits that give the number back, without exponent or trailing zeros."""
    plain = F.regexp_replace(v.cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    near = (F.abs(v) < 1e19) & (plain.cast("double") == v)
    return F.when(near, plain).otherwise(v.cast("string"))


def _pair_text(p: Column) -> Column:
    return F.concat_ws(" ", number_text(p["x"]), number_text(p["y"]))


def point_text(x: Column, y: Column) -> Column:
    return F.concat(F.lit("POINT("), number_text(x), F.lit(" "), number_text(y), F.lit(")"))


def line_text(pts: Column) -> Column:
    body = F.array_join(F.transform(pts, _pair_text), ", ")
    return F.concat(F.lit("LINESTRING("), body, F.lit(")"))


def parse_text(wkt: Column) -> Column:
    """Coordinates of a POINT or LINESTRING text, as a list of points."""
    body = F.regexp_extract(wkt, r"\(\s*(.*?)\s*\)", 1)
    return F.transform(
        F.split(body, r"\s*,\s*"),
        lambda s: let(
            F.split(s, r"\s+"),
            lambda w: point(
                F.element_at(w, 1).try_cast("double"), F.element_at(w, 2).try_cast("double")
            ),
        ),
    )


# ---- exploding to rows -------------------------------------------------------------


def segment_rows(df: DataFrame, *keep: str) -> DataFrame:
    """One row per segment of ``pts``: the kept columns, seg, x1, y1, x2, y2."""
    return df.select(*keep, F.posexplode(line_edges(F.col("pts"))).alias("seg", "e")).select(
        *keep, "seg", "e.*"
    )
