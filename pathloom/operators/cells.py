"""Spatial joins as equi-joins on square grid cells.

Each shape is listed under the cells its (grown) outline touches; shapes that
share a cell are tested exactly.  Catalyst sees an ordinary equi-join; it is asked
to sort both sides, because it takes a listing by cell for as small as the table
it is made of, and would broadcast it whatever its size.  A hot cell is split by
the skew-join handling of adaptive execution.  Cells are about as wide as the
distance asked for, which keeps candidates close to results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathloom.functions import geom as G

CELL = ("cx", "cy")

# Places closer than this (metres) to a shared end node are that node.
SHARED_M = 1e-6


def _range(lo: Column, hi: Column, size: float) -> Column:
    return F.sequence(F.floor(lo / size), F.floor(hi / size))


def box_cells(x0: Column, y0: Column, x1: Column, y1: Column, size: float) -> Column:
    """Cells that a box touches, as an array of (cx, cy)."""
    return F.flatten(
        F.transform(
            _range(x0, x1, size),
            lambda cx: F.transform(
                _range(y0, y1, size), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy"))
            ),
        )
    )


def segment_cells(x1, y1, x2, y2, size: float, grow: float = 0.0) -> Column:
    """Cells near a segment; a long one is followed in steps of one cell."""
    steps = F.greatest(F.ceil(G.distance(x1, y1, x2, y2) / size), F.lit(1)).cast("int")
    slack = grow + 1e-6

    def box(i: Column) -> tuple[Column, Column, Column, Column]:
        def at(k: Column) -> tuple[Column, Column]:
            f = k / steps
            return x1 + f * (x2 - x1), y1 + f * (y2 - y1)

        (ax, ay), (bx, by) = at(i), at(i + 1)
        return F.least(ax, bx) - slack, F.least(ay, by) - slack, F.greatest(ax, bx) + slack, F.greatest(ay, by) + slack

    def piece(i: Column) -> Column:
        # both ends of the boxes move one way only, so that a cell of an earlier box that
        # lies in this one lies in the box before it too
        lox, loy, hix, hiy = (F.floor(v / size) for v in box(i - 1))
        new = lambda c: (i == 0) | (c["cx"] < lox) | (c["cx"] > hix) | (c["cy"] < loy) | (c["cy"] > hiy)
        return F.filter(box_cells(*box(i), size), new)

    return F.flatten(F.transform(F.sequence(F.lit(0), steps - 1), piece))


def point_rows(points: DataFrame, size: float) -> DataFrame:
    return points.withColumns(
        {"cx": F.floor(F.col("x") / size), "cy": F.floor(F.col("y") / size)}
    )


def line_rows(lines: DataFrame, key: str, size: float, grow: float = 0.0) -> DataFrame:
    """key, seg, x1, y1, x2, y2 under every cell near the segment."""
    segs = G.segment_rows(lines, key)
    cells = segment_cells(*(F.col(c) for c in ("x1", "y1", "x2", "y2")), size, grow)
    return segs.withColumn("cell", F.explode(cells)).select("*", "cell.cx", "cell.cy").drop("cell")


# Where in a cell its reference point lies, as shares of the cell: off any round number,
# so that no polygon vertex is level with it.
SPOT = (0.381966011, 0.723606798)

# Cells of a row that share a join key: 2 ** 3.
STRIP = 3


def strip(cx: Column) -> Column:
    return F.shiftright(cx, STRIP)


def _scan_events(size: float) -> Column:
    """What one polygon edge e tells about cells: every cell it passes, with the edge, and
    in each row of cells whose reference line it crosses, the first cell to the right."""
    e = F.col("e")
    edge = F.struct(*[e[c].alias(c) for c in ("x1", "y1", "x2", "y2")])
    passed = F.transform(
        segment_cells(e["x1"], e["y1"], e["x2"], e["y2"], size),
        lambda c: F.struct(c["cx"].alias("cx"), c["cy"].alias("cy"), F.lit(0).alias("turn"), edge.alias("edge")),
    )

    def first_row(y: Column) -> Column:
        return F.ceil(y / size - SPOT[1])

    lo, hi = first_row(F.least(e["y1"], e["y2"])), first_row(F.greatest(e["y1"], e["y2"])) - 1

    def turn(cy: Column) -> Column:
        y0 = (cy + SPOT[1]) * size
        at = e["x1"] + (y0 - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"])
        return F.struct((F.floor(at / size - SPOT[0]) + 1).alias("cx"), cy.alias("cy"), F.lit(1).alias("turn"), F.when(F.lit(False), edge).alias("edge"))

    turns = F.transform(F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>")), turn)
    return F.concat(passed, turns)


def zone_cells(zones: DataFrame, keep: list[str], size: float) -> DataFrame:
    """Kept columns, cy, strip, from, to, x0, y0, held, near: the cells a polygon covers.

    A boundary cell is a row of its own (to = from + 1): ``near`` holds the polygon edges
    in it and ``held`` says whether its reference point (x0, y0) lies in the polygon.
    Cells between are runs of a row of cells, cut at strips of 2 ** STRIP cells, with a
    null ``near``.

    Found by scanlines: an edge that crosses the line of reference points of a row turns
    inside to outside from there on, so a running sum along the row says which cells are
    held.  The work follows the boundary; no task or row sees a whole polygon.
    """
    shapes = zones.select(F.monotonically_increasing_id().alias("_z"), *keep, "rings")
    edges = shapes.select("_z", *keep, F.explode(G.polygon_edges(F.col("rings"))).alias("e"))
    events = edges.select("_z", *keep, F.explode(_scan_events(size)).alias("v")).select("_z", *keep, "v.*")
    cells = events.groupBy("_z", *keep, "cy", "cx").agg(F.sum("turn").alias("turns"), F.collect_list("edge").alias("near"))
    row = Window.partitionBy("_z", *keep, "cy").orderBy("cx")
    cells = cells.withColumns({
        "held": F.sum("turns").over(row.rowsBetween(Window.unboundedPreceding, 0)) % 2 == 1,
        "next": F.lead("cx").over(row),
    })
    edge = F.size("near") > 0
    after = F.col("cx") + edge.cast("int")
    own = F.struct(F.col("cx").alias("from"), (F.col("cx") + 1).alias("to"), F.col("near").alias("near"))
    strips = F.sequence(strip(after), strip(F.col("next") - 1))
    none = F.when(F.lit(False), F.col("near"))

    def piece(k: Column) -> Column:
        first = F.shiftleft(k, STRIP)
        return F.struct(F.greatest(first, after).alias("from"), F.least(first + (1 << STRIP), F.col("next")).alias("to"), none.alias("near"))

    nothing = F.filter(F.array(own), lambda _: F.lit(False))
    runs = F.when(F.col("held") & (F.col("next") > after), F.transform(strips, piece)).otherwise(nothing)
    listed = F.concat(F.when(edge, F.array(own)).otherwise(nothing), runs)
    cover = cells.select(*keep, "cy", "held", F.explode(listed).alias("r")).select(*keep, "cy", "held", "r.*")
    return cover.withColumns({"strip": strip(F.col("from")), "x0": (F.col("from") + SPOT[0]) * size, "y0": (F.col("cy") + SPOT[1]) * size})


def in_cover(rows: DataFrame, cover: DataFrame) -> DataFrame:
    """Rows with a cell (cx, cy) joined with the cover of every zone that has the cell."""
    here = rows.withColumn("strip", strip(F.col("cx")))
    return here.join(cover.hint("merge"), ["cy", "strip"]).filter((F.col("cx") >= F.col("from")) & (F.col("cx") < F.col("to")))


def _inside_cell(x: Column, y: Column) -> Column:
    """Whether a point of a cell lies in the polygon or on its boundary: the way from the
    reference point, along y and then along x, crosses the edges in the cell."""
    x0, y0 = F.col("x0"), F.col("y0")

    def along_y(e: Column) -> Column:
        spans = (e["x1"] > x0) != (e["x2"] > x0)
        at = e["y1"] + (x0 - e["x1"]) / F.nullif(e["x2"] - e["x1"], F.lit(0.0)) * (e["y2"] - e["y1"])
        return spans & ((at > y0) != (at > y))

    def along_x(e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        at = e["x1"] + (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) * (e["x2"] - e["x1"])
        return spans & ((at > x0) != (at > x))

    def crossings(test) -> Column:
        return F.aggregate("near", F.lit(0), lambda n, e: n + F.when(test(e), 1).otherwise(0))

    odd = (crossings(along_y) + crossings(along_x)) % 2 == 1
    on = F.exists("near", lambda e: G.on_segment(x, y, e["x1"], e["y1"], e["x2"], e["y2"]))
    return F.when(F.col("near").isNull(), F.col("held")).otherwise((F.col("held") != odd) | on)


def points_in_zones(
    points: DataFrame, zones: DataFrame, keep: list[str], within: float = 0.0, size: float = 1000.0
) -> DataFrame:
    """Rows of ``points`` with the kept columns of each zone within the distance."""
    x, y = F.col("x"), F.col("y")
    here = point_rows(points, size)
    hit = in_cover(here, zone_cells(zones, keep, size)).filter(_inside_cell(x, y)).select(*points.columns, *keep)
    if not within:
        return hit
    gap = G.point_segment(x, y, F.col("c1"), F.col("d1"), F.col("c2"), F.col("d2"))
    close = here.join(ring_rows(zones, keep, size, within).hint("merge"), list(CELL)).filter(gap <= within)
    return hit.unionByName(close.select(*points.columns, *keep)).dropDuplicates()


def ring_rows(zones: DataFrame, keep: list[str], size: float, grow: float) -> DataFrame:
    """Kept columns and one polygon edge (c1, d1, c2, d2) under every cell near the edge."""
    edges = zones.select(*keep, F.explode(G.polygon_edges(F.col("rings"))).alias("e"))
    edges = edges.select(
        *keep,
        F.col("e.x1").alias("c1"),
        F.col("e.y1").alias("d1"),
        F.col("e.x2").alias("c2"),
        F.col("e.y2").alias("d2"),
    )
    cells = segment_cells(*(F.col(c) for c in ("c1", "d1", "c2", "d2")), size, grow)
    return edges.withColumn("cell", F.explode(cells)).select("*", "cell.cx", "cell.cy").drop("cell")


def ring_distance(
    lines: DataFrame, zones: DataFrame, key: str, keep: list[str], within: float
) -> DataFrame:
    """key, kept columns, ring_dist: distance to the boundary of each zone it is near.

    Only polygon edges close to the line are looked at, however long the
    boundary is.
    """
    size = max(2 * within, 250.0)
    s = [F.col(c) for c in ("x1", "y1", "x2", "y2", "c1", "d1", "c2", "d2")]
    apart = (
        (F.greatest(s[0], s[2]) < F.least(s[4], s[6]) - within)
        | (F.least(s[0], s[2]) > F.greatest(s[4], s[6]) + within)
        | (F.greatest(s[1], s[3]) < F.least(s[5], s[7]) - within)
        | (F.least(s[1], s[3]) > F.greatest(s[5], s[7]) + within)
    )
    return (
        line_rows(lines, key, size)
        .join(ring_rows(zones, keep, size, within).hint("merge"), list(CELL))
        .filter(~apart)
        .withColumn("ring_dist", G.segment_distance(*s))
        .filter(F.col("ring_dist") <= within)
        .groupBy(key, *keep)
        .agg(F.min("ring_dist").alias("ring_dist"))
    )


def _first_points(lines: DataFrame, key: str) -> DataFrame:
    at = G.line_start(F.col("pts"))
    return lines.select(key, at["x"].alias("x"), at["y"].alias("y"))


def line_zone_distance(
    lines: DataFrame, zones: DataFrame, key: str, keep: list[str], within: float
) -> DataFrame:
    """key, kept zone columns, dist to the zone and, if within reach, to its boundary.

    A line that keeps clear of the boundary is inside if its first point is.
    """
    ring = ring_distance(lines, zones, key, keep, within)
    held = points_in_zones(_first_points(lines, key), zones, keep).select(key, *keep)
    both = ring.withColumn("held", F.lit(False)).unionByName(
        held.withColumns({"ring_dist": F.lit(None).cast("double"), "held": F.lit(True)})
    )
    dist = F.when(F.bool_or("held"), F.lit(0.0)).otherwise(F.min("ring_dist"))
    return both.groupBy(key, *keep).agg(dist.alias("dist"), F.min("ring_dist").alias("ring_dist"))


def cell_pieces(segs: DataFrame, size: float) -> DataFrame:
    """Segments (x1, y1, x2, y2) cut at the borders of cells: a row per piece, with the
    cell that holds it."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))

    def cuts(a: Column, b: Column) -> Column:
        lo, hi = F.floor(F.least(a, b) / size) + 1, F.ceil(F.greatest(a, b) / size) - 1
        lines = F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(lines, lambda k: (k * size - a) / (b - a))

    at = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), cuts(x1, x2), cuts(y1, y2))))
    at = F.filter(at, lambda t: t.between(0.0, 1.0))
    n = F.size("at")
    both = F.zip_with(F.slice("at", F.lit(1), n - 1), F.slice("at", F.lit(2), n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    a, b = F.col("s.a"), F.col("s.b")
    cut = segs.withColumn("at", at).withColumn("s", F.explode(both))
    placed = {
        "x1": x1 + a * (x2 - x1), "y1": y1 + a * (y2 - y1), "x2": x1 + b * (x2 - x1), "y2": y1 + b * (y2 - y1),
        "cx": F.floor((x1 + (a + b) / 2 * (x2 - x1)) / size), "cy": F.floor((y1 + (a + b) / 2 * (y2 - y1)) / size),
    }
    return cut.withColumns(placed).drop("at", "s")


def _clip_in_cell() -> Column:
    """Length of a piece inside the polygon, judged by the edges in its cell and the
    reference point alone; null where it doesn't meet the polygon."""
    x1, y1, x2, y2 = s = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    crossings = F.transform("near", lambda e: G.crossing_at(*s, e["x1"], e["y1"], e["x2"], e["y2"]))
    stops = F.concat(F.filter(crossings, lambda t: t.isNotNull()), F.array(F.lit(0.0), F.lit(1.0)))
    stops = F.array_sort(F.array_distinct(stops))

    def part(a: Column, b: Column) -> Column:
        mid = (a + b) / 2
        return F.when(_inside_cell(x1 + mid * (x2 - x1), y1 + mid * (y2 - y1)), b - a)

    shares = G.pairs(stops, part)
    share = F.aggregate(shares, F.lit(None).cast("double"), lambda t, v: F.when(v.isNull(), t).otherwise(F.coalesce(t, F.lit(0.0)) + v))
    touch = F.exists("near", lambda e: G.segments_meet(*s, e["x1"], e["y1"], e["x2"], e["y2"]))
    whole = G.distance(*s)
    clipped = F.coalesce(share, F.when(touch, F.lit(0.0))) * whole
    return F.when(F.col("near").isNull(), whole).otherwise(clipped)


def line_zone_overlap(
    lines: DataFrame, zones: DataFrame, key: str, keep: list[str], size: float = 500.0
) -> DataFrame:
    """key, kept zone columns, segment_length: length of the line inside each zone it meets.

    Lines are cut at cell borders.  A piece in a cell that a zone covers counts whole; one
    in a boundary cell is clipped against the edges in that cell.  The join is on cells.
    """
    pieces = cell_pieces(G.segment_rows(lines, key), size)
    met = in_cover(pieces, zone_cells(zones, keep, size)).withColumn("segment_length", _clip_in_cell())
    met = met.filter(F.col("segment_length").isNotNull())
    return met.groupBy(key, *keep).agg(F.sum("segment_length").alias("segment_length"))


def points_near_lines(
    points: DataFrame, lines: DataFrame, point_key: str, line_key: str, within: float
) -> DataFrame:
    """point_key, line_key, dist for every pair within the distance."""
    size = max(2 * within, 100.0)
    left = point_rows(points.select(point_key, "x", "y"), size)
    dist = G.point_segment(*(F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")))
    return (
        left.join(line_rows(lines, line_key, size, within).hint("merge"), list(CELL))
        .withColumn("d", dist)
        .filter(F.col("d") <= within)
        .groupBy(point_key, line_key)
        .agg(F.min("d").alias("dist"))
    )


# Places on a line closer than this share of a segment are one.
SAME_PLACE = 1e-6


def _meetings(left: DataFrame, right: DataFrame, left_key: str, right_key: str, size: float) -> DataFrame:
    """id1, id2, pos, p for each pair of segments that meet, but not at a shared end node.
    ``pos`` is the segment of the first line plus the share of it up to the place."""

    def own(frame: DataFrame, key: str) -> Column:
        ends = [G.line_start(F.col("pts")).alias("a"), G.line_end(F.col("pts")).alias("b")]
        return F.struct(key, "source", "target", *ends)

    a = line_rows(left.withColumn("k1", own(left, left_key)), "k1", size)
    b = line_rows(right.withColumn("k2", own(right, right_key)), "k2", size)
    b = b.select("k2", "cx", "cy", *[F.col(c).alias(c + "b") for c in ("x1", "y1", "x2", "y2")])
    s = [F.col(c) for c in ("x1", "y1", "x2", "y2", "x1b", "y1b", "x2b", "y2b")]
    (s1, t1), (s2, t2) = ((F.col(f"{k}.source"), F.col(f"{k}.target")) for k in ("k1", "k2"))
    p = F.col("p")

    def at_end(end: Column) -> Column:
        return G.distance(p["x"], p["y"], end["x"], end["y"]) <= SHARED_M

    shared = (((s1 == s2) | (s1 == t2)) & at_end(F.col("k1.a"))) | (((t1 == s2) | (t1 == t2)) & at_end(F.col("k1.b")))
    dx, dy = s[2] - s[0], s[3] - s[1]
    pos = F.col("seg") + F.coalesce(F.try_divide((p["x"] - s[0]) * dx + (p["y"] - s[1]) * dy, dx * dx + dy * dy), F.lit(0.0))
    return (
        a.join(b.hint("merge"), list(CELL))
        .filter(F.col(f"k1.{left_key}") != F.col(f"k2.{right_key}"))
        .filter(G.segments_meet(*s))
        # a row of its own, so that the place is worked out once
        .withColumn("p", F.explode(F.array(G.meeting_point(*s))))
        .filter(~shared)
        .select(F.col(f"k1.{left_key}").alias("id1"), F.col(f"k2.{right_key}").alias("id2"), pos.alias("pos"), "p")
    )


def lines_meeting(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, size: float = 250.0
) -> DataFrame:
    """id1, id2, the number of places where two lines meet, and the least one.

    ``left`` and ``right`` hold their key, source, target and pts.  The place of an
    end node that two lines share does not count: those are found by node, in one
    pass over the link ends, and at a hub they would be all pairs of its links.
    """
    met = _meetings(left, right, left_key, right_key, size)
    return met.groupBy("id1", "id2").agg(F.count_distinct("p").alias("places"), F.min("p").alias("p"))


def meeting_places(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, size: float = 250.0
) -> DataFrame:
    """id1, id2, place, p: every place where two lines meet, numbered along the first.

    A corner that two segments share gives one place: positions along the line that
    follow each other within ``SAME_PLACE`` are one, and its least point stands for it.
    """
    met = _meetings(left, right, left_key, right_key, size).distinct()
    along = Window.partitionBy("id1", "id2").orderBy("pos", "p")
    apart = F.coalesce((F.col("pos") - F.lag("pos").over(along) > SAME_PLACE).cast("int"), F.lit(1))
    numbered = met.withColumn("new", apart).withColumn("place", F.sum("new").over(along))
    return numbered.groupBy("id1", "id2", "place").agg(F.min("p").alias("p"))
