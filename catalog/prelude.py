"""The derived network as SQL common table expressions for DuckDB."""

PRELUDE = """
g AS (SELECT max(p_partkey // 40) + 1 AS nrow FROM part),
fx_node AS (
  SELECT p_partkey AS nodeid, p_partkey % 40 AS c, p_partkey // 40 AS r,
         ((p_partkey % 40) * 100 + (p_partkey * 37) % 41 - 20)::DOUBLE AS x,
         ((p_partkey // 40) * 100 + (p_partkey * 53) % 41 - 20)::DOUBLE AS y
  FROM part),
fx_raw AS (
  SELECT a.nodeid * 2 AS id, a.r * 2 AS road, 'no' AS bridge, a.nodeid AS source, b.nodeid AS target,
         a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_
  FROM fx_node a JOIN fx_node b ON b.nodeid = a.nodeid + 1 WHERE a.c < 39 AND (a.nodeid * 7) % 11 <> 0
  UNION ALL
  SELECT a.nodeid * 2 + 1, a.c * 2 + 1, 'no', a.nodeid, b.nodeid, a.x, a.y, b.x, b.y
  FROM fx_node a JOIN fx_node b ON b.nodeid = a.nodeid + 40 WHERE (a.nodeid * 13) % 5 IN (0, 1)
  UNION ALL
  SELECT a.nodeid + 1000000, 205, 'yes', a.nodeid, b.nodeid, a.x, a.y, b.x, b.y
  FROM fx_node a JOIN fx_node b ON b.nodeid = a.nodeid + 82 WHERE a.c < 38 AND a.nodeid % 17 = 3
  UNION ALL
  SELECT a.nodeid + 2000000, 1, 'no', a.nodeid, a.nodeid, a.x, a.y, a.x, a.y
  FROM fx_node a WHERE a.nodeid % 101 = 0),
fx_mid AS (
  SELECT *, CASE WHEN source = target THEN ax + 30 ELSE (ax + bx) / 2 + id % 7 - 3 END AS mx,
            CASE WHEN source = target THEN ay + 30 ELSE (ay + by_) / 2 + id % 5 - 2 END AS my
  FROM fx_raw),
fx_attr AS (
  SELECT id, source, target, bridge, ax, ay, mx, my, bx, by_,
    CASE WHEN id % 23 = 0 THEN 'footway' WHEN id % 41 = 0 THEN 'track' WHEN road % 50 = 41 THEN 'motorway'
         WHEN road % 20 = 0 THEN 'trunk' WHEN road % 10 = 0 THEN 'primary' WHEN road % 10 = 5 THEN 'secondary'
         WHEN road % 3 = 0 THEN 'tertiary' ELSE 'residential' END AS highway,
    CASE WHEN id % 29 = 0 THEN NULL WHEN id % 37 = 0 THEN 'Mill ' || road || ' Roundabout'
         WHEN road % 11 = 3 THEN 'Hill ' || road || ' Crescent' WHEN road % 11 = 5 THEN 'Oak ' || road || ' Grove'
         WHEN road % 11 = 7 THEN 'High Street ' || road
         WHEN road % 7 = 0 AND id % 3 <> 0 THEN 'Main ' || road || ' Road / Church ' || road || ' Lane'
         ELSE 'Main ' || road || ' Road' END AS name,
    CASE WHEN id % 13 = 0 THEN 'yes' WHEN id % 17 = 0 THEN '-1' WHEN id % 19 = 0 THEN 'no' END AS oneway,
    CASE WHEN id % 11 = 0 THEN 'no' WHEN id % 7 = 0 THEN NULL ELSE 'yes' END AS foot,
    CASE WHEN id % 31 = 0 THEN 'yes' ELSE 'no' END AS rail,
    CASE WHEN id % 37 = 0 THEN 'roundabout' END AS junction,
    sqrt((mx - ax) * (mx - ax) + (my - ay) * (my - ay))
      + sqrt((bx - mx) * (bx - mx) + (by_ - my) * (by_ - my)) AS length
  FROM fx_mid),
fx_link AS MATERIALIZED (
  SELECT *, CASE WHEN oneway = '-1' THEN -1 ELSE length END AS cost,
            CASE WHEN oneway = 'yes' THEN -1 ELSE length END AS reverse_cost
  FROM fx_attr),
fx_seg AS (
  SELECT id, 1 AS seg, ax AS x1, ay AS y1, mx AS x2, my AS y2 FROM fx_link
  UNION ALL SELECT id, 2, mx, my, bx, by_ FROM fx_link),
fx_zone AS (
  SELECT n_nationkey::BIGINT AS zid, 'Z' || lpad(n_nationkey::VARCHAR, 3, '0') AS lsoa21cd, n_name AS lsoa21nm,
         CASE WHEN n_regionkey < 3 THEN 'internal' ELSE 'external' END AS zone_system,
         ((n_nationkey % 5) * 800 - 50)::DOUBLE AS xmin, ((n_nationkey % 5) * 800 + 750)::DOUBLE AS xmax,
         ((n_nationkey // 5) * nrow * 20 - 50)::DOUBLE AS ymin,
         ((n_nationkey // 5 + 1) * nrow * 20 - 50)::DOUBLE AS ymax
  FROM nation, g),
fx_centroid AS (
  SELECT s_suppkey AS centroid_id, ((s_suppkey * 7919) % 4000)::DOUBLE AS x,
         ((s_suppkey * 104729) % (nrow * 100))::DOUBLE AS y FROM supplier, g),
fx_stop AS (
  SELECT c_custkey AS stop_id, ((c_custkey * 6151) % 4000)::DOUBLE AS x,
         ((c_custkey * 3571) % (nrow * 100))::DOUBLE AS y FROM customer, g),
fx_address AS (
  SELECT c_custkey AS uprn, CASE c_mktsegment WHEN 'BUILDING' THEN 'RD04' WHEN 'HOUSEHOLD' THEN 'RD02'
         WHEN 'FURNITURE' THEN 'CR08' WHEN 'MACHINERY' THEN 'CI01' ELSE 'LP03' END AS class,
         ((c_custkey * 4409) % 4000)::DOUBLE AS x, ((c_custkey * 2897) % (nrow * 100))::DOUBLE AS y
  FROM customer, g)
"""


def sql(body: str, ctes: str = "", recursive: bool = False) -> str:
    """A whole statement: the derived tables, further CTEs, and the query."""
    head = "WITH RECURSIVE " if recursive else "WITH "
    more = f",\n{ctes.strip().strip(',')}" if ctes.strip() else ""
    return f"{head}{PRELUDE.strip()}{more}\n{body.strip()}"


# ---- pieces of SQL for the plane -------------------------------------------------


def dist(ax, ay, bx, by) -> str:
    return f"sqrt(({ax}-({bx}))*({ax}-({bx}))+({ay}-({by}))*({ay}-({by})))"


def pt_seg(px, py, x1="x1", y1="y1", x2="x2", y2="y2") -> str:
    """Distance from a point to a segment."""
    dx, dy = f"({x2}-{x1})", f"({y2}-{y1})"
    t = (
        f"least(greatest(coalesce((({px}-{x1})*{dx}+({py}-{y1})*{dy})"
        f"/nullif({dx}*{dx}+{dy}*{dy},0),0),0),1)"
    )
    return dist(px, py, f"{x1}+{t}*{dx}", f"{y1}+{t}*{dy}")


def clip(side: str) -> str:
    """Entry ('in') or exit ('out') position of the segment in the box of a zone."""
    pick, start, stop = ("least", "0", "2") if side == "in" else ("greatest", "1", "-1")

    def axis(a: str) -> str:
        return (
            f"CASE WHEN {a}2 = {a}1 THEN CASE WHEN {a}1 BETWEEN {a}min AND {a}max THEN {start} ELSE {stop} END "
            f"ELSE {pick}(({a}min-{a}1)/({a}2-{a}1), ({a}max-{a}1)/({a}2-{a}1)) END"
        )

    outer = "greatest(0.0," if side == "in" else "least(1.0,"
    return f"{outer} {axis('x')}, {axis('y')})"


def to_box(px, py) -> str:
    gx = f"greatest(xmin-{px},0,{px}-xmax)"
    gy = f"greatest(ymin-{py},0,{py}-ymax)"
    return f"sqrt({gx}*{gx}+{gy}*{gy})"


SEG_ZONE = f"""
seg_zone AS MATERIALIZED (
  SELECT *, CASE WHEN t0 <= t1 THEN 0 ELSE least({to_box('x1', 'y1')}, {to_box('x2', 'y2')},
      {pt_seg('xmin', 'ymin')}, {pt_seg('xmax', 'ymin')}, {pt_seg('xmin', 'ymax')}, {pt_seg('xmax', 'ymax')}) END AS d,
    t0 <= t1 AND NOT (x1 > xmin AND x1 < xmax AND y1 > ymin AND y1 < ymax
                      AND x2 > xmin AND x2 < xmax AND y2 > ymin AND y2 < ymax) AS on_ring
  FROM (SELECT s.*, z.*, {clip('in')} AS t0, {clip('out')} AS t1 FROM fx_seg s, fx_zone z)),
link_zone AS (SELECT zid, id, min(d) AS d, bool_or(on_ring) AS on_ring FROM seg_zone GROUP BY ALL)
"""

# Link ends, the degree without and with loops.
ENDS = """
fx_end AS (SELECT id, source AS node, 'source' AS e FROM fx_link UNION ALL SELECT id, target, 'target' FROM fx_link),
deg AS (SELECT node, count(*) AS degree FROM fx_end JOIN fx_link USING (id) WHERE source <> target GROUP BY node),
deg_all AS (SELECT node, count(*) AS degree FROM fx_end GROUP BY node)
"""

# The filters of the modes.
MODE_SQL = {
    "foot": "foot <> 'no' AND rail = 'no'",
    "bike": "rail = 'no' AND highway NOT IN ('motorway', 'motorway_link')",
    "car": "rail = 'no' AND highway IN ('motorway', 'motorway_link', 'trunk', 'trunk_link', 'primary', "
    "'primary_link', 'secondary', 'secondary_link', 'tertiary', 'tertiary_link', 'unclassified', 'residential')",
}


def near_sql(mode: str) -> str:
    """The mode's links, usable nodes, nearest nodes and undirected arcs."""
    return f"""
m_link AS (SELECT * FROM fx_link WHERE {MODE_SQL[mode]}),
m_node AS (SELECT * FROM fx_node WHERE nodeid IN (SELECT source FROM m_link UNION SELECT target FROM m_link)),
near AS MATERIALIZED (
  SELECT centroid_id, nodeid AS node_id, d AS dist, nx AS x, ny AS y FROM (
    SELECT c.centroid_id, n.nodeid, n.x AS nx, n.y AS ny, {dist('c.x', 'c.y', 'n.x', 'n.y')} AS d,
           row_number() OVER (PARTITION BY c.centroid_id ORDER BY {dist('c.x', 'c.y', 'n.x', 'n.y')}, n.nodeid) AS rn
    FROM fx_centroid c, m_node n) WHERE rn = 1),
m_way AS (
  SELECT id, source, target, CASE WHEN cost >= 0 AND (reverse_cost < 0 OR cost <= reverse_cost) THEN cost
         ELSE reverse_cost END AS w
  FROM m_link WHERE source <> target AND (cost >= 0 OR reverse_cost >= 0)),
arc AS MATERIALIZED (
  SELECT src, dst, min(w) AS w, arg_min(edge, (w, edge)) AS edge FROM (
    SELECT source AS src, target AS dst, id AS edge, w FROM m_way
    UNION ALL SELECT target, source, id, w FROM m_way) GROUP BY src, dst)"""


DIRECTED_ARC = """
arc AS MATERIALIZED (
  SELECT src, dst, min(w) AS w, arg_min(edge, (w, edge)) AS edge FROM (
    SELECT source AS src, target AS dst, id AS edge, cost AS w FROM fx_link WHERE source <> target
    UNION ALL SELECT target, source, id, reverse_cost FROM fx_link WHERE source <> target)
  WHERE w >= 0 GROUP BY src, dst)"""


def reach_sql(seeds: str, radius: float | None) -> str:
    """Least (cost, hops) per origin and node; ``seeds`` selects the origins."""
    bound = f"WHERE r.d + a.w <= {radius}" if radius else ""
    return f"""
r(o, n, d, h) USING KEY (o, n) AS (
  SELECT o, o, 0.0::DOUBLE, 0 FROM ({seeds})
  UNION
  SELECT c.o, c.n, c.d, c.h FROM (
    SELECT o, n, d, h, row_number() OVER (PARTITION BY o, n ORDER BY d, h) AS rn FROM (
      SELECT r.o, a.dst AS n, r.d + a.w AS d, r.h + 1 AS h FROM r JOIN arc a ON a.src = r.n {bound})) c
  LEFT JOIN recurring.r q ON q.o = c.o AND q.n = c.n
  WHERE c.rn = 1 AND (q.d IS NULL OR c.d < q.d OR (c.d = q.d AND c.h < q.h))),
pred AS (
  SELECT b.o, b.n, b.d, b.h, min((a.src, a.edge, a.w)) AS p
  FROM r b JOIN arc a ON a.dst = b.n JOIN r f ON f.o = b.o AND f.n = a.src AND f.d + a.w = b.d AND f.h + 1 = b.h
  WHERE b.h > 0 GROUP BY ALL)"""
