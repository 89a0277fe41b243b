"""Sources, sinks, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import links, nodes, query, r6, table
from catalog.prelude import MODE_SQL, SEG_ZONE, dist, pt_seg, sql
from pathloom.functions import geom as G
from pathloom.functions import text as T
from pathloom.operators import matrix as M
from pathloom.operators import network as O
from pathloom.operators.ranks import numbered
from pathloom.operators import route as R
from pathloom.operators import selection as S
from pathloom.session import scratch_path
from pathloom.sources import files
from pathloom.sources import network as N

NUM = r"regexp_replace(({})::DECIMAL(20,6)::VARCHAR, '\.?0+$', '')"


def num(v: str) -> str:
    return NUM.format(v)


LINE_TEXT = (
    f"'LINESTRING(' || {num('ax')} || ' ' || {num('ay')} || ', ' || {num('mx')} || ' ' || {num('my')}"
    f" || ', ' || {num('bx')} || ' ' || {num('by_')} || ')'"
)

# ---- sources and sinks ------------------------------------------------------------


@query(
    "s1_bus_lanes_csv",
    sql(f"""
SELECT id::VARCHAR AS osid, DATE '2024-01-01' + (id % 300)::INTEGER AS versiondate, {LINE_TEXT} AS geometry,
       round(length, 6) AS geometry_length_m, 'Lane "' || coalesce(name, 'none') || '", way ' || id AS description,
       oneway AS buslaneinfo_direction FROM fx_link"""),
)
def s1(spark, sf):
    """Bus lanes written as the 26-column file and loaded through the fixed schema."""
    made = {
        "osid": F.col("id").cast("string"),
        "versiondate": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")),
        "geometry": G.line_text(F.col("pts")),
        "geometry_length_m": r6("length"),
        "description": F.concat(
            F.lit('Lane "'), F.coalesce("name", F.lit("none")), F.lit('", way '), F.col("id").cast("string")
        ),
        "buslaneinfo_direction": F.col("oneway"),
    }
    fields = files.empty(spark, files.BUS_LANE_COLUMNS).schema.fields
    src = links(spark, sf).select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )
    path = scratch_path(spark, "bus_lanes")
    files.write_csv(src, path)
    lanes = files.read_bus_lanes(spark, path)
    return lanes.select(*made)


@query(
    "s2_stop_times_csv",
    sql("""
SELECT l_orderkey::VARCHAR AS trip_id, strftime(l_shipdate, '%H:%M:%S') AS arrival_time,
       l_suppkey::VARCHAR AS stop_id, l_linenumber AS stop_sequence FROM lineitem"""),
)
def s2_stop_times(spark, sf):
    path = scratch_path(spark, "stop_times")
    at = F.date_format("l_shipdate", "HH:mm:ss")
    made = {
        "trip_id": F.col("l_orderkey").cast("string"),
        "arrival_time": at,
        "departure_time": at,
        "stop_id": F.col("l_suppkey").cast("string"),
        "stop_sequence": F.col("l_linenumber").cast("int"),
    }
    fields = files.empty(spark, files.STOP_TIME_COLUMNS).schema.fields
    src = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )
    files.write_csv(src, path)
    return files.read_stop_times(spark, path).select("trip_id", "arrival_time", "stop_id", "stop_sequence")


@query(
    "s2_trips_csv",
    sql("""SELECT (o_custkey % 50)::VARCHAR AS route_id, o_orderkey::VARCHAR AS trip_id,
       o_orderpriority AS trip_headsign FROM orders"""),
)
def s2_trips(spark, sf):
    path = scratch_path(spark, "trips")
    made = {
        "route_id": (F.col("o_custkey") % 50).cast("string"),
        "trip_id": F.col("o_orderkey").cast("string"),
        "trip_headsign": F.col("o_orderpriority"),
    }
    fields = files.empty(spark, files.TRIP_COLUMNS).schema.fields
    src = spark.read.parquet(f"{sf}/orders.parquet").select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )
    files.write_csv(src, path)
    return files.read_trips(spark, path).select(*made)


@query("s3_parse_line_text", sql("SELECT id, 3 AS points, ax, ay, mx, my, bx, by_ FROM fx_link"))
def s3(spark, sf):
    wkt = links(spark, sf).select("id", G.line_text(F.col("pts")).alias("wkt"))
    p = F.col("p")
    return wkt.select("id", G.parse_text(F.col("wkt")).alias("p")).select(
        "id",
        F.size("p").alias("points"),
        *[
            p[i][c].alias(n)
            for i, c, n in (
                (0, "x", "ax"), (0, "y", "ay"), (1, "x", "mx"), (1, "y", "my"), (2, "x", "bx"), (2, "y", "by_")
            )
        ],
    )


@query("s3_parse_point_text", sql("SELECT centroid_id, x, y FROM fx_centroid"))
def s3_point(spark, sf):
    wkt = N.centroids(spark, sf).select("centroid_id", G.point_text(F.col("x"), F.col("y")).alias("wkt"))
    at = F.element_at(G.parse_text(F.col("wkt")), 1)
    return wkt.select("centroid_id", at["x"].alias("x"), at["y"].alias("y"))


@query("s4_line_text", sql(f"SELECT id, {LINE_TEXT} AS wkt FROM fx_link"))
def s4(spark, sf):
    return links(spark, sf).select("id", G.line_text(F.col("pts")).alias("wkt"))


@query(
    "s5_required_columns",
    sql("SELECT zid, lsoa21cd, lsoa21nm, zone_system FROM fx_zone"),
)
def s5(spark, sf):
    cols = ["zid", "lsoa21cd", "lsoa21nm", "zone_system"]
    return files.require_columns(N.zones(spark, sf), cols, "zones").select(*cols)


@query("s6_s7_table_round_trip", sql("SELECT id, source, target, round(length, 6) AS length FROM fx_link"))
def s6(spark, sf):
    path = scratch_path(spark, "edge_table")
    for _ in range(2):  # the second write replaces the first
        files.write_table(links(spark, sf), path)
    return files.read_table(spark, path, ["id", "source", "target"]).select(
        "id", "source", "target", r6("length").alias("length")
    )


@query(
    "s8_append_zones",
    sql(
        """SELECT id, min(zid) AS first_zone, count(*) AS zones FROM link_zone WHERE d = 0 GROUP BY id""",
        SEG_ZONE,
    ),
)
def s8(spark, sf):
    """Each zone's links appended to one table; one zone is then run again."""
    from pathloom.operators.cells import line_zone_distance

    rows = line_zone_distance(links(spark, sf), N.zones(spark, sf), "id", ["zid"], 0.0).select("zid", "id")
    path = scratch_path(spark, "full")
    files.append_zones(rows, path)
    files.append_zones(rows.filter(F.col("zid") == 0), path)
    full = spark.read.parquet(path)
    return full.groupBy("id").agg(
        F.min("zid").cast("bigint").alias("first_zone"), F.count(F.lit(1)).alias("zones")
    )


# ---- projections --------------------------------------------------------------------


@query("p1_first_last_node", sql("SELECT id AS wayid, source, target FROM fx_link"))
def p1(spark, sf):
    raw = N.raw_links(spark, sf)
    return raw.select(
        "wayid", T.first_node(F.col("nodes")).alias("source"), T.last_node(F.col("nodes")).alias("target")
    )


@query(
    "p2_oneway_costs",
    sql("SELECT id, round(cost, 6) AS cost, round(reverse_cost, 6) AS reverse_cost FROM fx_link"),
)
def p2(spark, sf):
    one, length = F.col("oneway"), F.col("length")
    return links(spark, sf).select(
        "id",
        r6(T.forward_cost(one, length)).alias("cost"),
        r6(T.backward_cost(one, length)).alias("reverse_cost"),
    )


GEO_CTES = """
ll AS (SELECT id, seg, radians(-2 + x1/70000) AS lo1, radians(53 + y1/111000) AS la1,
              radians(-2 + x2/70000) AS lo2, radians(53 + y2/111000) AS la2 FROM fx_seg),
red AS (SELECT *, atan((1 - 1/298.257223563) * tan(la1)) AS b1, atan((1 - 1/298.257223563) * tan(la2)) AS b2 FROM ll),
arc0 AS (SELECT *, 2 * asin(least(1.0, sqrt(pow(sin((b2 - b1)/2), 2)
          + cos(b1) * cos(b2) * pow(sin((lo2 - lo1)/2), 2)))) AS s, (b1 + b2)/2 AS p, (b2 - b1)/2 AS q FROM red),
geo AS (SELECT id, seg, 6378137.0 * (s - (1/298.257223563)/2 * (
          (s - sin(s)) * pow(sin(p) * cos(q), 2) / pow(cos(s/2), 2)
        + (s + sin(s)) * coalesce(pow(cos(p) * sin(q), 2) / nullif(pow(sin(s/2), 2), 0), 0))) AS len FROM arc0)
"""


@query(
    "p3_geodesic_length",
    sql("SELECT id, round(sum(len), 3) AS length_m FROM geo GROUP BY id", GEO_CTES),
)
def p3(spark, sf):
    raw = N.raw_links(spark, sf)
    return raw.select(F.col("wayid").alias("id"), r6(G.geodesic_length(F.col("pts")), 3).alias("length_m"))


@query("p4_planar_length", sql("SELECT id, round(length, 6) AS length FROM fx_link"))
def p4(spark, sf):
    return links(spark, sf).select("id", r6(G.line_length(F.col("pts"))).alias("length"))


GRID_CTES = """
k AS (SELECT 6378137.0::DOUBLE AS wa, (1/298.257223563)::DOUBLE AS wf, 6377563.396::DOUBLE AS a, 6356256.909::DOUBLE AS b,
        radians(-0.1502/3600) AS rx, radians(-0.2470/3600) AS ry, radians(-0.8421/3600) AS rz,
        (1 + 20.4894e-6)::DOUBLE AS s, 0.9996012717::DOUBLE AS f0, radians(49.0) AS p0, radians(-2.0) AS l0),
ll AS (SELECT nodeid, radians(53 + y/111000) AS la, radians(-2 + x/70000) AS lo FROM fx_node),
c1 AS (SELECT nodeid, k.*, la, lo, wa / sqrt(1 - wf*(2-wf) * pow(sin(la), 2)) AS nu FROM ll, k),
c2 AS (SELECT *, nu*cos(la)*cos(lo) AS x, nu*cos(la)*sin(lo) AS y, nu*(1 - wf*(2-wf))*sin(la) AS z FROM c1),
c3 AS (SELECT nodeid, a, b, f0, p0, l0, -446.448 + s*x - rz*y + ry*z AS x, 125.157 + rz*x + s*y - rx*z AS y,
          -542.060 - ry*x + rx*y + s*z AS z FROM c2),
c4 AS (SELECT *, 1 - pow(b/a, 2) AS e2, sqrt(x*x + y*y) AS h, atan2(z*a, sqrt(x*x + y*y)*b) AS th FROM c3),
c5 AS (SELECT *, atan2(z + (pow(a/b, 2) - 1)*b*pow(sin(th), 3), h - e2*a*pow(cos(th), 3)) AS p,
          atan2(y, x) - l0 AS d, (a-b)/(a+b) AS n FROM c4),
c6 AS (SELECT *, a*f0/sqrt(1 - e2*pow(sin(p), 2)) AS nu, a*f0*(1-e2)/pow(1 - e2*pow(sin(p), 2), 1.5) AS rho,
          pow(tan(p), 2) AS t2, b*f0*((1 + n + 1.25*n*n + 1.25*pow(n,3))*(p-p0)
            - (3*n + 3*n*n + 2.625*pow(n,3))*sin(p-p0)*cos(p+p0)
            + (1.875*n*n + 1.875*pow(n,3))*sin(2*(p-p0))*cos(2*(p+p0))
            - 35.0/24*pow(n,3)*sin(3*(p-p0))*cos(3*(p+p0))) AS m FROM c5),
grid AS (SELECT nodeid,
   400000 + nu*cos(p)*d + nu/6*pow(cos(p),3)*(nu/rho - t2)*pow(d,3)
     + nu/120*pow(cos(p),5)*(5 - 18*t2 + t2*t2 + 14*(nu/rho-1) - 58*t2*(nu/rho-1))*pow(d,5) AS east,
   m - 100000 + nu/2*sin(p)*cos(p)*d*d + nu/24*sin(p)*pow(cos(p),3)*(5 - t2 + 9*(nu/rho-1))*pow(d,4)
     + nu/720*sin(p)*pow(cos(p),5)*(61 - 58*t2 + t2*t2)*pow(d,6) AS north FROM c6)
"""


@query(
    "p5_national_grid",
    sql("SELECT nodeid, round(east, 2) AS east, round(north, 2) AS north FROM grid", GRID_CTES),
)
def p5(spark, sf):
    deg = nodes(spark, sf).select("nodeid", N.degrees(F.col("x"), F.col("y")).alias("p"))
    out = deg.select("nodeid", G.to_grid(F.col("p.x"), F.col("p.y")).alias("g"))
    return out.select("nodeid", r6("g.x", 2).alias("east"), r6("g.y", 2).alias("north"))


@query(
    "p6_line_ends",
    sql("SELECT id, ax AS start_x, ay AS start_y, bx AS end_x, by_ AS end_y, bx AS back_x FROM fx_link"),
)
def p6(spark, sf):
    pts = F.col("pts")
    return links(spark, sf).select(
        "id",
        G.line_start(pts)["x"].alias("start_x"),
        G.line_start(pts)["y"].alias("start_y"),
        G.line_end(pts)["x"].alias("end_x"),
        G.line_end(pts)["y"].alias("end_y"),
        G.line_start(F.reverse(pts))["x"].alias("back_x"),
    )


@query(
    "p7_grown_envelope",
    sql("""SELECT highway, least(min(ax), min(mx), min(bx)) - 200 AS x0, least(min(ay), min(my), min(by_)) - 200 AS y0,
  greatest(max(ax), max(mx), max(bx)) + 200 AS x1, greatest(max(ay), max(my), max(by_)) + 200 AS y1
  FROM fx_link GROUP BY highway"""),
)
def p7(spark, sf):
    return R.boxes(links(spark, sf).select(F.col("highway").alias("route_id"), "pts")).withColumnRenamed(
        "route_id", "highway"
    )


@query(
    "p8_p9_point_to_line",
    sql(f"""
SELECT id, round({dist('ax', 'ay', 'bx', 'by_')}, 6) AS straight,
       round(least({pt_seg('ax + 13', 'ay + 7', 'ax', 'ay', 'mx', 'my')},
                   {pt_seg('ax + 13', 'ay + 7', 'mx', 'my', 'bx', 'by_')}), 6) AS off_line FROM fx_link"""),
)
def p8(spark, sf):
    a, b = G.line_start(F.col("pts")), G.line_end(F.col("pts"))
    return links(spark, sf).select(
        "id",
        r6(G.distance(a["x"], a["y"], b["x"], b["y"])).alias("straight"),
        r6(G.point_line(a["x"] + 13, a["y"] + 7, F.col("pts"))).alias("off_line"),
    )


PT = ("ax + 13", "ay + 7")
T1 = f"least(greatest(coalesce((({PT[0]}-ax)*(mx-ax)+({PT[1]}-ay)*(my-ay))/nullif((mx-ax)*(mx-ax)+(my-ay)*(my-ay),0),0),0),1)"
T2 = f"least(greatest(coalesce((({PT[0]}-mx)*(bx-mx)+({PT[1]}-my)*(by_-my))/nullif((bx-mx)*(bx-mx)+(by_-my)*(by_-my),0),0),0),1)"
LOCATED = f"""
l0 AS (SELECT *, {T1} AS t1, {T2} AS t2, {dist('ax', 'ay', 'mx', 'my')} AS len1 FROM fx_link),
l1 AS (SELECT *, ax + t1*(mx-ax) AS qx1, ay + t1*(my-ay) AS qy1, mx + t2*(bx-mx) AS qx2, my + t2*(by_-my) AS qy2 FROM l0),
l2 AS (SELECT *, {dist(PT[0], PT[1], 'qx1', 'qy1')} AS d1, {dist(PT[0], PT[1], 'qx2', 'qy2')} AS d2 FROM l1),
loc AS (SELECT *, CASE WHEN d1 <= d2 THEN 0 ELSE 1 END AS seg, CASE WHEN d1 <= d2 THEN qx1 ELSE qx2 END AS qx,
          CASE WHEN d1 <= d2 THEN qy1 ELSE qy2 END AS qy,
          CASE WHEN d1 <= d2 THEN {dist('ax', 'ay', 'qx1', 'qy1')} ELSE len1 + {dist('mx', 'my', 'qx2', 'qy2')} END AS run
        FROM l2)"""


@query(
    "p11_locate_on_line",
    sql(
        """SELECT id, round(run / length, 6) AS fraction, round(qx, 6) AS x, round(qy, 6) AS y FROM loc""",
        LOCATED,
    ),
)
def p11(spark, sf):
    pts = F.col("pts")
    a = G.line_start(pts)
    at = links(spark, sf).select("id", "length", "pts", G.locate(a["x"] + 13, a["y"] + 7, pts).alias("at"))
    return at.select(
        "id",
        r6(G.measure(pts, F.col("at")) / F.col("length")).alias("fraction"),
        r6("at.x").alias("x"),
        r6("at.y").alias("y"),
    )


@query(
    "p12_snap_line",
    sql(
        f"""SELECT id, round(px, 6) AS x1, round(py, 6) AS y1, round(qx + coalesce((qx-px)*0.1/nullif(g,0), 0), 6) AS x2,
        round(qy + coalesce((qy-py)*0.1/nullif(g,0), 0), 6) AS y2
        FROM (SELECT *, ax + 13 AS px, ay + 7 AS py, {dist(PT[0], PT[1], 'qx', 'qy')} AS g FROM loc)""",
        LOCATED,
    ),
)
def p12(spark, sf):
    pts = F.col("pts")
    a = G.line_start(pts)
    px, py = a["x"] + 13, a["y"] + 7
    at = links(spark, sf).select("id", px.alias("px"), py.alias("py"), G.locate(px, py, pts).alias("at"))
    line = G.lengthen(F.col("px"), F.col("py"), F.col("at.x"), F.col("at.y"), R.RUN_ON_M)
    return at.select("id", line.alias("l")).select(
        "id",
        r6(F.col("l")[0]["x"]).alias("x1"),
        r6(F.col("l")[0]["y"]).alias("y1"),
        r6(F.col("l")[1]["x"]).alias("x2"),
        r6(F.col("l")[1]["y"]).alias("y2"),
    )


@query(
    "p13_split_line",
    sql(
        """SELECT id, 0 AS part, seg + 2 AS points, round(run, 6) AS length FROM loc
           UNION ALL SELECT id, 1, 3 - seg, round(length - run, 6) FROM loc""",
        LOCATED,
    ),
)
def p13(spark, sf):
    pts, at = F.col("pts"), F.col("at")
    a = G.line_start(pts)
    rows = links(spark, sf).select("id", "pts", G.locate(a["x"] + 13, a["y"] + 7, pts).alias("at"))
    both = F.posexplode(F.array(G.part_before(pts, at), G.part_after(pts, at))).alias("part", "piece")
    return rows.select("id", both).select(
        "id", "part", F.size("piece").alias("points"), r6(G.line_length(F.col("piece"))).alias("length")
    )


@query(
    "p16_boundary_ring",
    sql("""SELECT zid, 0 AS ring, 5 AS points, 2*(xmax-xmin) + 2*(ymax-ymin) AS length FROM fx_zone"""),
)
def p16(spark, sf):
    rings = N.zones(spark, sf).select("zid", F.posexplode("rings").alias("ring", "pts"))
    return rings.select("zid", "ring", F.size("pts").alias("points"), G.line_length(F.col("pts")).alias("length"))


@query(
    "p18_clean_names",
    sql("""
SELECT id, array_to_string(list_sort(list_distinct([
  replace(replace(regexp_replace(regexp_replace(s, '\\{', ''), ' / ', '_'), '"', ''), '}', '')
  for s in string_split('{"' || name || '",Old ' || name || '}', ',')])), ',') AS names
FROM fx_link WHERE name IS NOT NULL"""),
)
def p18(spark, sf):
    """Names as they look after a merge: braces, quotes, two names in one text."""
    merged = F.concat(F.lit('{"'), F.col("name"), F.lit('",Old '), F.col("name"), F.lit("}"))
    rows = links(spark, sf).filter(F.col("name").isNotNull())
    tidy = F.array_sort(F.array_distinct(T.clean_names(merged)))
    return rows.select("id", F.array_join(tidy, ",").alias("names"))


@query(
    "p19_distance_band",
    sql("""SELECT id, CASE WHEN length*100 < 5000 THEN '0-5 km' WHEN length*100 < 10000 THEN '5-10 km'
  WHEN length*100 < 15000 THEN '10-15 km' WHEN length*100 < 20000 THEN '15-20 km'
  WHEN length*100 < 25000 THEN '20-25 km' ELSE '25+ km' END AS band FROM fx_link"""),
)
def p19(spark, sf):
    return links(spark, sf).select("id", T.distance_band(F.col("length") * 100).alias("band"))


@query("p20_metres_to_km", sql("SELECT source AS origin, target, round(length / 1000, 9) AS value_km FROM fx_link"))
def p20(spark, sf):
    rows = links(spark, sf).select(F.col("source").alias("origin"), "target", F.col("length").alias("value"))
    return M.to_km(rows).select("origin", "target", r6("value_km", 9).alias("value_km"))


@query(
    "p21_id_arrays",
    sql("""SELECT id, 2 AS members, true AS has_id, id::VARCHAR || ',' || (id + 2)::VARCHAR AS ids FROM fx_link"""),
)
def p21(spark, sf):
    ids = F.array_append(F.array(F.col("id").cast("string")), (F.col("id") + 2).cast("string"))
    rows = links(spark, sf).select("id", ids.alias("ids"))
    return rows.select(
        "id",
        F.size("ids").alias("members"),
        F.array_contains("ids", F.col("id").cast("string")).alias("has_id"),
        F.array_join("ids", ",").alias("ids"),
    )


@query("p22_row_id", sql("SELECT row_number() OVER (ORDER BY length, id) AS rowid, id FROM fx_link"))
def p22(spark, sf):
    rows, _ = numbered(links(spark, sf).select("id", "length"), ["length", "id"], name="rowid")
    return rows.select("rowid", "id")


# ---- filters --------------------------------------------------------------------------


def _mode_query(mode: str, alias: str) -> None:
    @query(f"f1_links_{mode}", sql(f"SELECT id, highway, foot, rail FROM fx_link WHERE {MODE_SQL[mode]}"))
    def run(spark, sf):
        return O.for_mode(links(spark, sf), alias).select("id", "highway", "foot", "rail")


for _mode, _alias in (("foot", "walk"), ("bike", "cycle"), ("car", "drive")):
    _mode_query(_mode, _alias)


@query(
    "f2_internal_zones",
    sql("SELECT zid, lsoa21cd FROM fx_zone WHERE zone_system = 'internal'"),
)
def f2(spark, sf):
    zones = N.zones(spark, sf)
    return zones.filter(F.col("zone_system") == "internal").select("zid", "lsoa21cd")


@query("f3_address_class", sql("SELECT uprn, class FROM fx_address WHERE substr(class, 1, 1) IN ('R', 'C')"))
def f3(spark, sf):
    rows = N.addresses(spark, sf)
    return rows.filter(F.substring("class", 1, 1).isin("R", "C")).select("uprn", "class")


@query(
    "f4_name_patterns",
    sql("""SELECT id, name NOT LIKE '%Crescent' AND name NOT LIKE '%Grove' AS kept,
  name LIKE '% Road%' OR name LIKE '% Roundabout%' AS road, name LIKE '%/%' AS dual FROM fx_link"""),
)
def f4(spark, sf):
    name = F.col("name")
    return links(spark, sf).select(
        "id",
        (~S.any_like(name, S.NAME_OUT)).alias("kept"),
        S.any_like(name, S.NAME_IN).alias("road"),
        S.is_dual(name).alias("dual"),
    )


@query(
    "f5_highway_class",
    sql("""SELECT id, highway IN ('primary','trunk','secondary','tertiary') AS main FROM fx_link
  WHERE highway NOT IN ('footway', 'track') AND name IS NOT NULL"""),
)
def f5(spark, sf):
    rows = links(spark, sf).filter(
        ~F.col("highway").isin(*S.NOT_AT_BOUNDARY) & F.col("name").isNotNull()
    )
    return rows.select("id", F.col("highway").isin(*S.MAIN_HIGHWAYS).alias("main"))


def trips(spark, sf):
    """Route ends: each centroid to the third one after it."""
    c = N.centroids(spark, sf)
    n = c.agg(F.count(F.lit(1))).scalar()
    a = c.select(
        F.col("centroid_id").alias("route_id"),
        F.col("x").alias("ox"),
        F.col("y").alias("oy"),
        ((F.col("centroid_id") + 3) % n).alias("k"),
    )
    b = c.select(F.col("centroid_id").alias("k"), F.col("x").alias("dx"), F.col("y").alias("dy"))
    return a.join(b, "k").select("route_id", "ox", "oy", "dx", "dy")


TRIPS = """
trip AS (SELECT a.centroid_id AS route_id, a.x AS ox, a.y AS oy, b.x AS dx, b.y AS dy
  FROM fx_centroid a JOIN fx_centroid b ON b.centroid_id = (a.centroid_id + 3) % (SELECT count(*) FROM fx_centroid))"""

BOX_HIT = """
hit AS (SELECT DISTINCT route_id, id FROM (
  SELECT route_id, id,
    greatest(0.0, CASE WHEN x1 = x2 THEN CASE WHEN x1 BETWEEN bx0 AND bx1 THEN 0 ELSE 2 END ELSE least((bx0-x1)/(x2-x1), (bx1-x1)/(x2-x1)) END,
      CASE WHEN y1 = y2 THEN CASE WHEN y1 BETWEEN by0 AND by1 THEN 0 ELSE 2 END ELSE least((by0-y1)/(y2-y1), (by1-y1)/(y2-y1)) END) AS t0,
    least(1.0, CASE WHEN x1 = x2 THEN CASE WHEN x1 BETWEEN bx0 AND bx1 THEN 1 ELSE -1 END ELSE greatest((bx0-x1)/(x2-x1), (bx1-x1)/(x2-x1)) END,
      CASE WHEN y1 = y2 THEN CASE WHEN y1 BETWEEN by0 AND by1 THEN 1 ELSE -1 END ELSE greatest((by0-y1)/(y2-y1), (by1-y1)/(y2-y1)) END) AS t1
  FROM (SELECT route_id, least(ox, dx) - 200 AS bx0, greatest(ox, dx) + 200 AS bx1,
               least(oy, dy) - 200 AS by0, greatest(oy, dy) + 200 AS by1 FROM trip), fx_seg) WHERE t0 <= t1)"""


@query("f6_links_in_route_box", sql("SELECT route_id, id FROM hit", TRIPS + "," + BOX_HIT))
def f6(spark, sf):
    t = table(spark, sf, "trips", lambda: trips(spark, sf))
    line = F.array(G.point(F.col("ox"), F.col("oy")), G.point(F.col("dx"), F.col("dy")))
    frames = R.boxes(t.select("route_id", line.alias("pts")))
    return R.links_in_boxes(frames, links(spark, sf))
