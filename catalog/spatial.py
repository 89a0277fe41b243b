"""Spatial and key joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.base import links, nodes, query, r6, table
from catalog.prelude import ENDS, SEG_ZONE, dist, near_sql, pt_seg, sql
from pathloom.functions import geom as G
from pathloom.operators import cells as C
from pathloom.operators import matrix as M
from pathloom.operators import network as O
from pathloom.operators import route as R
from pathloom.operators import selection as S
from pathloom.operators.nearest import nearest_link, nearest_nodes
from pathloom.sources import network as N

IN_ZONE = "x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax"


@query("j1_nodes_in_zones", sql(f"SELECT nodeid, lsoa21cd FROM fx_node JOIN fx_zone ON {IN_ZONE}"))
def j1(spark, sf):
    return C.points_in_zones(nodes(spark, sf), N.zones(spark, sf), ["lsoa21cd"]).select("nodeid", "lsoa21cd")


@query(
    "j2_addresses_in_zones",
    sql(f"""SELECT uprn, class, lsoa21cd, lsoa21nm FROM fx_address JOIN fx_zone ON {IN_ZONE}
  WHERE substr(class, 1, 1) IN ('R', 'C')"""),
)
def j2(spark, sf):
    rows = N.addresses(spark, sf).filter(F.substring("class", 1, 1).isin("R", "C"))
    found = C.points_in_zones(rows, N.zones(spark, sf), ["lsoa21cd", "lsoa21nm"])
    return found.select("uprn", "class", "lsoa21cd", "lsoa21nm")


OVERLAP = (
    SEG_ZONE
    + """,
overlap AS (SELECT id, lsoa21cd, lsoa21nm, sum((t1 - t0) * sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1))) AS len
  FROM seg_zone WHERE t0 <= t1 GROUP BY id, lsoa21cd, lsoa21nm)"""
)


@query(
    "j3_p14_link_zone_overlap",
    sql("SELECT id, lsoa21cd, lsoa21nm, round(len, 5) AS segment_length FROM overlap", OVERLAP),
)
def j3(spark, sf):
    got = C.line_zone_overlap(links(spark, sf), N.zones(spark, sf), "id", ["lsoa21cd", "lsoa21nm"])
    return got.withColumn("segment_length", r6("segment_length", 5))


@query(
    "a1_longest_zone_per_link",
    sql(
        """SELECT id, lsoa21nm, round(len, 5) AS segment_length
  FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY round(len, 5) DESC) AS k FROM overlap) WHERE k = 1""",
        OVERLAP,
    ),
)
def a1(spark, sf):
    """The zone with the longest stretch of each link; ties are kept."""
    part = table(spark, sf, "link_zones", lambda: j3(spark, sf))
    longest = F.rank().over(Window.partitionBy("id").orderBy(F.desc("segment_length")))
    return part.withColumn("k", longest).filter("k = 1").select("id", "lsoa21nm", "segment_length")


def near_line(within: float, table_name: str, key: str) -> str:
    d = pt_seg("p.x", "p.y", "s.x1", "s.y1", "s.x2", "s.y2")
    return f"""
near_line AS (SELECT p.{key}, s.id, min({d}) AS d FROM {table_name} p, fx_seg s
  WHERE p.x BETWEEN least(s.x1, s.x2) - {within} AND greatest(s.x1, s.x2) + {within}
    AND p.y BETWEEN least(s.y1, s.y2) - {within} AND greatest(s.y1, s.y2) + {within}
  GROUP BY p.{key}, s.id HAVING min({d}) <= {within})"""


def _within_query(within: float) -> None:
    label = f"{within:g}"

    @query(
        f"j4_points_within_{label}m_of_links",
        sql("SELECT stop_id, id, round(d, 6) AS dist FROM near_line", near_line(within, "fx_stop", "stop_id")),
    )
    def run(spark, sf):
        got = C.points_near_lines(N.stops(spark, sf), links(spark, sf), "stop_id", "id", within)
        return got.withColumn("dist", r6("dist"))


for _d in (3.0, 12.0, 50.0, 100.0):
    _within_query(_d)


def _line_zone_query(within: float) -> None:
    @query(
        f"j5_p10_links_within_{within:g}m_of_zones",
        sql(f"SELECT zid, id, round(d, 6) AS dist FROM link_zone WHERE d <= {within}", SEG_ZONE),
    )
    def run(spark, sf):
        got = C.line_zone_distance(links(spark, sf), N.zones(spark, sf), "id", ["zid"], within)
        return got.select("zid", "id", r6("dist").alias("dist"))


for _d in (0.0, 50.0, 150.0):
    _line_zone_query(_d)


@query(
    "j6_nodes_within_250m_of_zones",
    sql("""SELECT nodeid, zid FROM fx_node JOIN fx_zone ON
  pow(greatest(xmin-x, 0, x-xmax), 2) + pow(greatest(ymin-y, 0, y-ymax), 2) <= 250*250"""),
)
def j6(spark, sf):
    return C.points_in_zones(nodes(spark, sf), N.zones(spark, sf), ["zid"], within=250.0).select("nodeid", "zid")


CROSSING = """
pair AS (
  SELECT a.id AS id1, b.id AS id2, a.seg - 1 AS seg, a.x1 AS p, a.y1 AS q, a.x2 - a.x1 AS ux, a.y2 - a.y1 AS uy,
         (a.x2-a.x1)*(b.y1-a.y1)-(a.y2-a.y1)*(b.x1-a.x1) AS s1, (a.x2-a.x1)*(b.y2-a.y1)-(a.y2-a.y1)*(b.x2-a.x1) AS s2,
         (b.x2-b.x1)*(a.y1-b.y1)-(b.y2-b.y1)*(a.x1-b.x1) AS s3, (b.x2-b.x1)*(a.y2-b.y1)-(b.y2-b.y1)*(a.x2-b.x1) AS s4,
         a.x1 AS ax1, a.y1 AS ay1, a.x2 AS ax2, a.y2 AS ay2, b.x1 AS bx1, b.y1 AS by1, b.x2 AS bx2, b.y2 AS by2
  FROM fx_seg a JOIN fx_seg b ON least(a.x1, a.x2) <= greatest(b.x1, b.x2) AND greatest(a.x1, a.x2) >= least(b.x1, b.x2)
   AND least(a.y1, a.y2) <= greatest(b.y1, b.y2) AND greatest(a.y1, a.y2) >= least(b.y1, b.y2) AND a.id <> b.id
),
meets AS (
  SELECT *, ((bx1-ax1)*(by2-by1)-(by1-ay1)*(bx2-bx1)) / nullif(ux*(by2-by1)-uy*(bx2-bx1), 0) AS t FROM pair
  WHERE (sign(s1)*sign(s2) < 0 AND sign(s3)*sign(s4) < 0)
     OR (s1 = 0 AND bx1 BETWEEN least(ax1,ax2) AND greatest(ax1,ax2) AND by1 BETWEEN least(ay1,ay2) AND greatest(ay1,ay2))
     OR (s2 = 0 AND bx2 BETWEEN least(ax1,ax2) AND greatest(ax1,ax2) AND by2 BETWEEN least(ay1,ay2) AND greatest(ay1,ay2))
     OR (s3 = 0 AND ax1 BETWEEN least(bx1,bx2) AND greatest(bx1,bx2) AND ay1 BETWEEN least(by1,by2) AND greatest(by1,by2))
     OR (s4 = 0 AND ax2 BETWEEN least(bx1,bx2) AND greatest(bx1,bx2) AND ay2 BETWEEN least(by1,by2) AND greatest(by1,by2))),
spots AS (
  SELECT *, CASE WHEN t IS NOT NULL THEN {'x': p + t*ux, 'y': q + t*uy} ELSE list_min([
      CASE WHEN s1 = 0 AND bx1 BETWEEN least(ax1,ax2) AND greatest(ax1,ax2) AND by1 BETWEEN least(ay1,ay2) AND greatest(ay1,ay2) THEN {'x': bx1, 'y': by1} END,
      CASE WHEN s2 = 0 AND bx2 BETWEEN least(ax1,ax2) AND greatest(ax1,ax2) AND by2 BETWEEN least(ay1,ay2) AND greatest(ay1,ay2) THEN {'x': bx2, 'y': by2} END,
      CASE WHEN s3 = 0 AND ax1 BETWEEN least(bx1,bx2) AND greatest(bx1,bx2) AND ay1 BETWEEN least(by1,by2) AND greatest(by1,by2) THEN {'x': ax1, 'y': ay1} END,
      CASE WHEN s4 = 0 AND ax2 BETWEEN least(bx1,bx2) AND greatest(bx1,bx2) AND ay2 BETWEEN least(by1,by2) AND greatest(by1,by2) THEN {'x': ax2, 'y': ay2} END]) END AS place
  FROM meets),
node_at AS (SELECT nodeid, x AS nx, y AS ny FROM fx_node),
met AS (
  SELECT m.id1, m.id2, m.place, m.seg + coalesce(((m.place.x - m.p) * m.ux + (m.place.y - m.q) * m.uy) / nullif(m.ux * m.ux + m.uy * m.uy, 0), 0) AS pos
  FROM spots m JOIN fx_link la ON la.id = m.id1 JOIN fx_link lb ON lb.id = m.id2
  WHERE NOT EXISTS (SELECT 1 FROM node_at n WHERE n.nodeid IN (la.source, la.target) AND n.nodeid IN (lb.source, lb.target)
    AND sqrt((m.place.x - nx) * (m.place.x - nx) + (m.place.y - ny) * (m.place.y - ny)) <= 1e-6))
"""


@query("j7_links_meeting_off_node", sql("SELECT DISTINCT id1, id2 FROM met", CROSSING))
def j7(spark, sf):
    """Ordered pairs of links that touch or cross away from a common end node."""
    rows = links(spark, sf)
    return C.lines_meeting(rows, rows, "id", "id").select("id1", "id2")


@query(
    "p15_crossing_points",
    sql(
        """SELECT id1, id2, k AS place, round(p.x, 3) AS x, round(p.y, 3) AS y FROM (
  SELECT id1, id2, CAST(k AS BIGINT) AS k, min(place) AS p FROM (
    SELECT *, sum(CASE WHEN pos - before <= 1e-6 THEN 0 ELSE 1 END) OVER (PARTITION BY id1, id2 ORDER BY pos, place) AS k
    FROM (SELECT *, lag(pos) OVER (PARTITION BY id1, id2 ORDER BY pos, place) AS before FROM (SELECT DISTINCT * FROM met)))
  GROUP BY ALL)""",
        CROSSING,
    ),
)
def p15(spark, sf):
    """Every place where two links meet, in order along the first."""
    rows = links(spark, sf)
    got = C.meeting_places(rows, rows, "id", "id")
    return got.select("id1", "id2", F.col("place").cast("bigint").alias("place"), r6("p.x", 3).alias("x"), r6("p.y", 3).alias("y"))


def _nearest_query(mode: str) -> None:
    @query(
        f"j8_nearest_node_{mode}",
        sql("SELECT centroid_id, node_id, round(dist, 6) AS dist, x, y FROM near", near_sql(mode)),
    )
    def run(spark, sf):
        got = near_nodes(spark, sf, mode)
        return got.withColumn("dist", r6("dist"))


def near_nodes(spark, sf, mode):
    def make():
        usable = O.usable_nodes(nodes(spark, sf), O.for_mode(links(spark, sf), mode))
        return nearest_nodes(N.centroids(spark, sf), usable)

    return table(spark, sf, f"near_{mode}", make)


for _mode in ("foot", "bike", "car"):
    _nearest_query(_mode)


@query(
    "j9_nearest_named_link",
    sql(
        """SELECT stop_id, id, round(d, 6) AS dist FROM (
  SELECT n.stop_id, n.id, n.d, row_number() OVER (PARTITION BY n.stop_id ORDER BY n.d, n.id) AS k
  FROM near_line n JOIN fx_link l USING (id) WHERE l.highway NOT IN ('footway') AND l.name IS NOT NULL) WHERE k = 1""",
        near_line(100.0, "fx_stop", "stop_id"),
    ),
)
def j9(spark, sf):
    got = nearest_link(N.stops(spark, sf), R.snappable(links(spark, sf)), "stop_id", 100.0)
    return got.withColumn("dist", r6("dist"))


@query(
    "j10_touching_link_per_roundabout",
    sql(
        """SELECT id, min(other) AS other FROM (
  SELECT a.id, b.id AS other FROM fx_end a JOIN fx_end b ON a.node = b.node AND a.id <> b.id
  UNION ALL SELECT id1, id2 FROM met) WHERE id IN (SELECT id FROM fx_link WHERE junction = 'roundabout') GROUP BY id""",
        ENDS + "," + CROSSING,
    ),
)
def j10(spark, sf):
    rows = links(spark, sf)
    return S.touching_links(rows.filter(F.col("junction") == "roundabout"), rows, [])


@query(
    "j11_usable_nodes_foot",
    sql("SELECT nodeid, x, y FROM m_node", near_sql("foot")),
)
def j11(spark, sf):
    return O.usable_nodes(nodes(spark, sf), O.for_mode(links(spark, sf), "foot"))


FORMER = "former AS (SELECT id, [id::VARCHAR, (id + 2)::VARCHAR] AS original_ids FROM fx_link WHERE id % 97 = 0)"


def former(spark, sf):
    """The accumulated result of earlier zones, as the fixtures define it."""
    ids = F.array(F.col("id").cast("string"), (F.col("id") + 2).cast("string"))
    return links(spark, sf).filter(F.col("id") % 97 == 0).withColumn("original_ids", ids)


@query("j12_not_in_result", sql("SELECT id FROM fx_link WHERE id NOT IN (SELECT id FROM former)", FORMER))
def j12(spark, sf):
    return links(spark, sf).join(former(spark, sf), "id", "left_anti").select("id")


@query(
    "j13_composite_key",
    sql("""SELECT l.id, (l.source, l.highway) IN (SELECT target, highway FROM fx_link WHERE source <> target) AS follows
  FROM fx_link l"""),
)
def j13(spark, sf):
    rows = links(spark, sf)
    key = rows.filter(F.col("source") != F.col("target")).select(
        F.col("target").alias("source"), "highway"
    ).distinct()
    yes = rows.join(key, ["source", "highway"], "left_semi").select("id", F.lit(True).alias("follows"))
    no = rows.join(key, ["source", "highway"], "left_anti").select("id", F.lit(False).alias("follows"))
    return yes.unionByName(no)


@query(
    "j14_not_a_member",
    sql(
        """SELECT id FROM fx_link l WHERE id NOT IN (SELECT id FROM former)
  AND id::VARCHAR NOT IN (SELECT unnest(original_ids) FROM former)""",
        FORMER,
    ),
)
def j14(spark, sf):
    full = former(spark, sf)
    return S.seed_working(links(spark, sf), links(spark, sf), full).join(full, "id", "left_anti").select("id")


@query(
    "j15_dual_names_by_part",
    sql(
        """SELECT DISTINCT a.zid, a.name AS long, b.name AS part FROM zn a JOIN zn b ON a.zid = b.zid
  WHERE a.name LIKE '%/%' AND b.name NOT LIKE '%/%' AND contains(a.name, b.name)""",
        SEG_ZONE
        + """, zn AS (SELECT DISTINCT zid, name FROM link_zone JOIN fx_link USING (id) WHERE d <= 50
         AND name IS NOT NULL)""",
    ),
)
def j15(spark, sf):
    near = table(spark, sf, "zone_near", lambda: S.zone_near(links(spark, sf), N.zones(spark, sf)))
    near = near.filter(F.col("dist") <= 50)
    names = table(
        spark, sf, "zone_names",
        lambda: near.filter(F.col("name").isNotNull()).select("zid", "name").distinct(),
    )
    dual = S.is_dual(F.col("name"))
    return S.names_containing(names.filter(dual), names.filter(~dual)).select("zid", "long", "part")


@query(
    "j16_links_adjacent_at_degree_2",
    sql(
        """SELECT a.node, a.id AS id1, b.id AS id2 FROM fx_end a JOIN fx_end b ON a.node = b.node AND a.id <> b.id
  JOIN deg_all d ON d.node = a.node WHERE d.degree = 2""",
        ENDS,
    ),
)
def j16(spark, sf):
    """Adjacent pairs where a node joins two link ends: two rows per node at most."""
    at = O.ends(links(spark, sf), "id")
    pair = at.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b")
    )
    pair = pair.filter((F.col("n") == 2) & (F.col("a") != F.col("b")))
    both = F.array(
        F.struct(F.col("a").alias("id1"), F.col("b").alias("id2")),
        F.struct(F.col("b").alias("id1"), F.col("a").alias("id2")),
    )
    return pair.select("node", F.explode(both).alias("p")).select("node", "p.*")


@query(
    "j16_neighbours_per_link_end",
    sql(
        """SELECT a.id, a.node, count(DISTINCT b.id) AS neighbours, count(DISTINCT b.oneway) AS oneway_kinds,
  min(b.id) AS least FROM fx_end a JOIN (SELECT DISTINCT node, id, oneway FROM fx_end JOIN fx_link USING (id)) b
  ON a.node = b.node WHERE a.e = 'source' GROUP BY ALL""",
        ENDS,
    ),
)
def j16_counts(spark, sf):
    """What the rules ask of adjacent links, per node instead of per pair: linear at any hub."""
    at = O.ends(links(spark, sf), "id", "oneway")
    here = at.dropDuplicates(["node", "id"])
    node = here.groupBy("node").agg(
        F.count(F.lit(1)).alias("neighbours"),
        F.count_distinct("oneway").alias("oneway_kinds"),
        F.min("id").alias("least"),
    )
    return at.filter(F.col("end") == "source").select("id", "node").join(node, "node").select(
        "id", "node", "neighbours", "oneway_kinds", "least"
    )


@query(
    "j19_m5_missing_centroids",
    sql("""SELECT z.zid, z.lsoa21cd FROM fx_zone z WHERE z.zone_system = 'internal'
  AND z.zid NOT IN (SELECT centroid_id FROM fx_centroid WHERE centroid_id % 3 <> 0)"""),
)
def j19(spark, sf):
    """Internal zones no centroid names, of a delivery that lacks every third centroid."""
    zones = N.zones(spark, sf).filter(F.col("zone_system") == "internal")
    delivered = N.centroids(spark, sf).filter(F.col("centroid_id") % 3 != 0)
    return M.missing_centroids(zones, delivered, "zid", "centroid_id").select("zid", "lsoa21cd")


@query(
    "j19_local_centroids",
    sql("""SELECT centroid_id, x, y, zid, lsoa21cd, lsoa21nm, zone_system FROM fx_centroid
  JOIN fx_zone ON centroid_id = zid WHERE zone_system = 'internal'"""),
)
def j19_local(spark, sf):
    zones = N.zones(spark, sf).filter(F.col("zone_system") == "internal")
    return M.local_centroids(zones, N.centroids(spark, sf), "zid", "centroid_id")


@query(
    "j21_candidates_with_counts",
    sql(
        """SELECT f.node, d.degree FROM (SELECT DISTINCT node FROM fx_end) f LEFT JOIN deg d USING (node)""",
        ENDS,
    ),
)
def j21(spark, sf):
    rows = links(spark, sf)
    return O.ends(rows, "id").select("node").distinct().join(O.degrees(rows), "node", "left")


@query(
    "j22_crow_fly_all_pairs",
    sql(
        f"""SELECT a.centroid_id AS origin, b.centroid_id AS target, round({dist('a.x', 'a.y', 'b.x', 'b.y')}, 6) AS value
  FROM near a, near b""",
        near_sql("foot"),
    ),
)
def j22(spark, sf):
    got = M.crow_fly(near_nodes(spark, sf, "foot"))
    return got.withColumn("value", r6("value"))


# ---- aggregates, set operations -----------------------------------------------------------


@query(
    "a2_length_per_name",
    sql("SELECT name, round(sum(length), 4) AS length FROM fx_link WHERE name IS NOT NULL GROUP BY name"),
)
def a2(spark, sf):
    rows = links(spark, sf).filter(F.col("name").isNotNull())
    return rows.groupBy("name").agg(r6(F.sum("length"), 4).alias("length"))


@query("a3_node_degree", sql("SELECT node, degree FROM deg", ENDS))
def a3(spark, sf):
    return O.degrees(links(spark, sf))


@query(
    "a4_counts_per_node",
    sql(
        """SELECT node, count(*) AS links, count(DISTINCT name) AS names, count(DISTINCT highway) AS classes
  FROM (SELECT DISTINCT node, id FROM fx_end) JOIN fx_link USING (id) GROUP BY node""",
        ENDS,
    ),
)
def a4(spark, sf):
    at = O.ends(links(spark, sf), "id", "name", "highway").dropDuplicates(["node", "id"])
    return at.groupBy("node").agg(
        F.count(F.lit(1)).alias("links"),
        F.count_distinct("name").alias("names"),
        F.count_distinct("highway").alias("classes"),
    )


@query(
    "a5_least_distance_link_to_stop",
    sql(
        "SELECT id, round(min(d), 6) AS dist FROM near_line GROUP BY id",
        near_line(50.0, "fx_stop", "stop_id"),
    ),
)
def a5(spark, sf):
    got = C.points_near_lines(N.stops(spark, sf), links(spark, sf), "stop_id", "id", 50.0)
    return got.groupBy("id").agg(r6(F.min("dist")).alias("dist"))


@query(
    "a6_joined_sets",
    sql("""SELECT highway, coalesce(array_to_string(list_sort(list_distinct(list(oneway))), ','), '') AS oneway,
  coalesce(array_to_string(list_sort(list_distinct(list(ferry))), ','), '') AS ferry,
  count(*) AS links FROM fx_full GROUP BY highway""", "fx_full AS (SELECT *, NULL::VARCHAR AS ferry FROM fx_link)"),
)
def a6(spark, sf):
    from pathloom.functions.text import joined_set

    return links(spark, sf).groupBy("highway").agg(
        joined_set(F.col("oneway")).alias("oneway"),
        joined_set(F.col("ferry")).alias("ferry"),
        F.count(F.lit(1)).alias("links"),
    )


@query(
    "a8_distinct_segments",
    sql(
        """SELECT x1, y1, x2, y2 FROM (SELECT DISTINCT least((x1, y1), (x2, y2)) AS a, greatest((x1, y1), (x2, y2)) AS b
  FROM fx_seg) t, LATERAL (SELECT a[1] AS x1, a[2] AS y1, b[1] AS x2, b[2] AS y2)"""
    ),
)
def a8(spark, sf):
    """The dissolved network: each stretch once, whichever way its links run."""
    seg = G.segment_rows(links(spark, sf), "id")
    a = G.point(F.col("x1"), F.col("y1"))
    b = G.point(F.col("x2"), F.col("y2"))
    once = seg.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    return once.select(
        F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2")
    )


@query(
    "a13_top_link_per_class",
    sql("""SELECT highway, arg_max(id, (length, -id)) AS longest, arg_min(id, (length, id)) AS shortest,
  min(id) AS lowest FROM fx_link GROUP BY highway"""),
)
def a13(spark, sf):
    return links(spark, sf).groupBy("highway").agg(
        F.max_by("id", F.struct("length", -F.col("id"))).alias("longest"),
        F.min_by("id", F.struct("length", "id")).alias("shortest"),
        F.min("id").alias("lowest"),
    )


@query(
    "a14_union_of_ends",
    sql("""SELECT node, count(*) AS times, 'all' AS kind FROM (SELECT source AS node FROM fx_link UNION ALL SELECT target FROM fx_link)
  GROUP BY node UNION ALL SELECT node, 1, 'distinct' FROM (SELECT source AS node FROM fx_link UNION SELECT target FROM fx_link)"""),
)
def a14(spark, sf):
    rows = links(spark, sf)
    a, b = rows.select(F.col("source").alias("node")), rows.select(F.col("target").alias("node"))
    every = a.unionByName(b).groupBy("node").agg(F.count(F.lit(1)).alias("times"))
    once = a.unionByName(b).distinct().withColumn("times", F.lit(1).cast("bigint"))
    return every.withColumn("kind", F.lit("all")).unionByName(once.withColumn("kind", F.lit("distinct")))


@query(
    "a15_distinct_rows",
    sql("SELECT DISTINCT highway, oneway, junction FROM fx_link"),
)
def a15(spark, sf):
    return links(spark, sf).select("highway", "oneway", "junction").distinct()
