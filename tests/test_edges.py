"""Hand-made cases at the edges: places that lack, parts, second merges, far nodes."""

import math

import pytest
from pyspark.sql import functions as F

from pathloom.functions import geom as G
from pathloom.operators import chains as H
from pathloom.operators import oneway as W
from pathloom.operators import reach as R
from pathloom.operators import route as T
from pathloom.operators import selection as S
from pathloom.operators.nearest import nearest_nodes
from pathloom.plans import simplify as P
from pathloom.session import scratch_path
from pathloom.sources import files

from conftest import link

RINGS = "zid bigint, rings array<array<struct<x:double,y:double>>>"


def square(x, y, side=100.0):
    x, y = float(x), float(y)
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]


def test_paths_with_costs_below_the_straight_line(spark, make_links, make_nodes):
    places = {i: (100 * i, 0) for i in range(7)}
    rows = [link(i, i, i + 1, [places[i], places[i + 1]], cost=50.0, reverse_cost=50.0) for i in range(6)]
    pairs = spark.createDataFrame([(1, 0, 6)], "route_id bigint, o bigint, d bigint")
    got = T.paths(pairs, make_links(rows), make_nodes(places)).orderBy("pos").collect()
    assert [r["node"] for r in got] == list(range(7)) and got[-1]["agg_cost"] == 300.0


def test_nearest_of_points_without_a_place(spark, make_nodes):
    nodes = make_nodes({1: (0, 0), 2: (100, 0)}).unionByName(
        spark.createDataFrame([(9, None, 1.0)], "nodeid bigint, x double, y double")
    )
    rows = [(1, None, 5.0), (2, math.nan, 5.0), (3, math.inf, 0.0), (4, 90.0, 1.0), (5, 1e7, 1e7)]
    points = spark.createDataFrame(rows, "centroid_id bigint, x double, y double")
    got = {r["centroid_id"]: r["node_id"] for r in nearest_nodes(points, nodes).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 2, 5: 2}


def test_boundary_of_a_zone_of_two_parts_with_a_hole(spark, make_links):
    zone = [square(0, 0), square(1000, 0), square(1020, 20, 40.0)]
    zones = spark.createDataFrame([(1, zone)], RINGS)
    kept = zones.select(G.outer_rings(F.col("rings")).alias("r")).first()["r"]
    assert [(r[0]["x"], r[0]["y"]) for r in kept] == [(0.0, 0.0), (1000.0, 0.0)]
    rows = [link(1, 1, 2, [(50, 50), (150, 50)]), link(2, 3, 4, [(1050, 90), (1050, 150)]), link(3, 5, 6, [(1040, 40), (1015, 40)])]
    got = S.boundary_links(make_links(rows), zones).collect()
    assert sorted(r["id"] for r in got) == [1, 2]


def test_second_merge_repeats_no_value_and_no_id(spark, make_links):
    rows = [
        link(1, 1, 2, [(0, 0), (1, 0)], highway="primary,residential", oneway="no,yes"),
        link(2, 2, 3, [(1, 0), (2, 0)], highway="residential", oneway="yes"),
    ]
    known = spark.createDataFrame([(70,)], "id bigint")
    got = H.contract(make_links(rows), spark.createDataFrame([(2,)], "node bigint"), known).collect()
    assert [(r["id"], r["highway"], r["oneway"]) for r in got] == [(71, "primary,residential", "no,yes")]


@pytest.mark.parametrize("value", ["0.1", "1234567.123456789", "-53.000000001", "0.0000001", "12345678901234.5", "0", "-0.5", "100"])
def test_number_text_is_exact(spark, value):
    got = spark.range(1).select(G.number_text(F.lit(float(value))).alias("t")).first()["t"]
    assert float(got) == float(value) and "E" not in got and not got.endswith(".0")


def test_blocks_stay_compact_beside_a_far_node(spark):
    def seams(extra):
        rows = [(i, float(i % 60), float(i // 60)) for i in range(3600)] + extra
        block = {r["node"]: r["block"] for r in R.node_blocks(spark.createDataFrame(rows, "nodeid bigint, x double, y double"), 144).collect()}
        assert max(list(block.values()).count(b) for b in set(block.values())) <= 144
        cross = {i for i in range(3600) for j in (i + 1, i + 60) if j < 3600 and (j != i + 1 or j % 60) and block[i] != block[j]}
        return len(cross)

    alone = seams([])
    assert alone < 0.35 * 3600
    assert seams([(9000, 1e7, 1e7), (9001, None, 0.0)]) <= 1.2 * alone


def test_conflict_counts_equal_the_pair_rule(spark, make_links):
    import random

    r = random.Random(6)
    rows = []
    for i in range(160):
        a, b = r.randrange(45), r.randrange(45)
        rows.append(link(i, a, b, [(a, 0), (b, 1)], name=r.choice([None, "A", "B"]), oneway=r.choice([None, "yes", "no", "-1"]),
                         junction=r.choice([None, "roundabout"]), highway=r.choice(["trunk", "residential"])))
    links = make_links(rows)
    zone = {i for i in range(160) if i % 3}
    deg = {}
    d = [x.asDict() for x in links.collect()]
    for x in d:
        for n in (x["source"], x["target"]):
            deg[n] = deg.get(n, 0) + 1
    want = {}
    for a in d:
        s, t = deg[a["source"]], deg[a["target"]]
        for b in d:
            if a["id"] == b["id"] or None in (a["oneway"], b["oneway"]) or a["oneway"] == b["oneway"] or 2 not in (s, t):
                continue
            if not {a["source"], a["target"]} & {b["source"], b["target"]}:
                continue
            c = want.setdefault(a["id"], [0, 0, 0, 0])
            c[0] += 1
            named = a["name"] is None or b["name"] is None or a["name"] == b["name"]
            if not named or (b["junction"] == "roundabout" and b["id"] in zone) or (a["id"] not in zone and a["highway"] != "trunk"):
                continue
            c[1] += 1
            if deg[b["source"]] > 2 and deg[b["target"]] > 2:
                continue
            c[2] += 1
            c[3] += not ((a["source"] in (b["source"], b["target"]) and s > 2) or (a["target"] == b["source"] and t > 2))
    in_zone = spark.createDataFrame([(i,) for i in zone], "id bigint")
    got = {x["id"]: [x["pairs"], x["pruned"], x["apart"], x["kept"]] for x in W.conflict_counts(links, links, in_zone).collect()}
    assert got == want


def test_links_merged_earlier_are_not_pruned(spark, make_links):
    rows = [link(1, 1, 2, [(0, 0), (1, 0)], oneway="yes"), link(2, 2, 3, [(1, 0), (2, 0)], oneway="no")]
    net = make_links(rows)
    nowhere = spark.createDataFrame([], "id bigint")
    pairs = W.conflict_pairs(net)
    assert W.prune_by_zone(pairs, net, nowhere).count() == 0
    assert W.prune_by_zone(pairs, net.filter("id > 9"), nowhere).count() == 2  # neither is an edge


def test_publish_twice(spark, make_links):
    zones = spark.createDataFrame([(1, [square(-10, -10)]), (2, [square(90, -10)])], RINGS)
    first = make_links([link(1, 1, 2, [(0, 0), (50, 0)]), link(2, 2, 3, [(50, 0), (150, 0)])])
    path = scratch_path(spark, "result")
    assert [r["id"] for r in P.publish(first, zones, path).orderBy("rowid").collect()] == [1, 2]
    again = make_links([link(7, 1, 2, [(0, 0), (50, 0)])])  # zone 1 anew; zone 2 stays
    got = P.publish(again, zones, path).orderBy("rowid").collect()
    assert [(r["rowid"], r["id"]) for r in got] == [(1, 2), (2, 7)]


def test_matrix_file_can_be_read_as_one(spark, tmp_path):
    rows = [(o, t, o * 100.0 + t) for o in (3, 1, 2) for t in (2, 1, 3)]
    df = spark.createDataFrame(rows, "origin bigint, target bigint, value double")
    from pathloom.operators import matrix as M

    path = str(tmp_path / "m")
    files.write_matrix(df, M.wide_rows(df), path, 1.0)
    text = "".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*")))
    assert text.splitlines() == ["origin,1,2,3", "1,101.0,102.0,103.0", "2,201.0,202.0,203.0", "3,301.0,302.0,303.0"]
    assert sorted(map(tuple, files.read_matrix(spark, path).collect())) == sorted(rows)


def test_full_matrix_is_filled_where_it_is_made(spark):
    """Every pair once, gaps filled, and no exchange of the full matrix."""
    import math

    from pathloom.operators import matrix as M
    from pathloom.session import materialise, setting

    places = {i: (i * 37 % 101 * 1.0, i * 53 % 89 * 1.0) for i in range(60)}
    near = materialise(spark.createDataFrame([(i, x, y) for i, (x, y) in places.items()], "centroid_id bigint, x double, y double"))
    known = {(i, j): 500.0 + i + j for i in range(60) for j in range(60) if (i + j) % 3 == 0}
    matrix = materialise(spark.createDataFrame([(i, j, v) for (i, j), v in known.items()], "origin bigint, target bigint, value double"))
    factor = spark.createDataFrame([(1.5,)], "factor double")
    got = {(r["origin"], r["target"]): (r["value"], r["from_network"]) for r in M.combined(matrix, near, factor).collect()}
    assert len(got) == 3600
    for pair, (value, network) in got.items():
        a, b = (places[i] for i in pair)
        assert (value, network) == (known[pair], True) if pair in known else (abs(value - 1.5 * math.dist(a, b)) < 1e-9 and not network)
    with setting(spark, M.TOGETHER_BY_SOME_KEYS, "false"):
        plan = M._filled(matrix, near, factor)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3  # the points of either axis and the network rows
