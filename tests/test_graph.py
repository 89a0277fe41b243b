"""Reach, routes and contraction on hand-made and random networks."""

import heapq
import random
from collections import defaultdict

import pytest
from conftest import link
from pyspark.sql import functions as F

from pathloom.operators import chains as H
from pathloom.operators import reach as R
from pathloom.operators import route as T


def dijkstra(arcs, origin, limit):
    best, heap = {}, [(0.0, 0, origin)]
    while heap:
        d, h, n = heapq.heappop(heap)
        if n in best:
            continue
        best[n] = (d, h)
        for m, w in arcs[n]:
            if d + w <= limit and m not in best:
                heapq.heappush(heap, (d + w, h + 1, m))
    return best


def random_network(seed, n=60, m=110, hub=False):
    rnd = random.Random(seed)
    places = {i: (rnd.uniform(0, 1000), rnd.uniform(0, 1000)) for i in range(n)}
    rows = []
    for i in range(m):
        a, b = rnd.randrange(n), rnd.randrange(n)
        if hub and i % 3 == 0:
            a = 0
        if i % 15 == 7:
            b = a
        pts = [places[a], places[b]] if a != b else [places[a], (places[a][0] + 5, places[a][1]), places[a]]
        rows.append(link(i, a, b, pts, oneway=rnd.choice([None, "yes", "-1", "no"])))
    return places, rows


@pytest.mark.parametrize("directed, hub, blocks", [(False, False, 8), (True, True, 8), (False, True, 1000)])
def test_reach_equals_dijkstra(spark, make_links, make_nodes, directed, hub, blocks):
    places, rows = random_network(3 + blocks, hub=hub)
    links = make_links(rows)
    arcs = R.directed_arcs(links) if directed else R.undirected_arcs(links)
    seeds = spark.createDataFrame([(i, i) for i in range(0, 60, 3)], "origin bigint, node bigint")
    found = R.search(seeds, arcs, make_nodes(places), 900.0, block_nodes=blocks)
    paths = R.reach(found).collect()
    got = defaultdict(dict)
    for r in paths:
        got[r["origin"]][r["node"]] = r
    graph = defaultdict(list)
    for r in arcs.collect():
        graph[r["src"]].append((r["dst"], r["w"]))
    for origin in range(0, 60, 3):
        want = dijkstra(graph, origin, 900.0)
        assert {n: (r["agg_cost"], r["depth"]) for n, r in got[origin].items()} == want
        for n, r in got[origin].items():
            before = got[origin][r["pred"]]
            assert r["agg_cost"] == before["agg_cost"] + r["cost"] or n == origin
    some = R.reach(found, spark.createDataFrame([(n,) for n in range(0, 60, 7)], "node bigint")).collect()
    assert sorted(map(tuple, some)) == sorted(tuple(r) for r in paths if r["node"] % 7 == 0)
    goals = spark.createDataFrame([(100 * o + n, o, n) for o in range(0, 60, 3) for n in range(0, 60, 4)], "route_id bigint, origin bigint, node bigint")
    walked = defaultdict(list)
    for r in R.walk_back(found, goals).collect():
        walked[r["route_id"]].append((r["depth"], r["node"], r["pred"], r["edge"], r["agg_cost"]))
    for o in range(0, 60, 3):
        for n in range(0, 60, 4):
            way, at = [], got[o].get(n)
            while at:
                way.append((at["depth"], at["node"], at["pred"], at["edge"], at["agg_cost"]))
                at = got[o][at["pred"]] if at["depth"] else None
            assert sorted(walked[100 * o + n]) == way[::-1]


def test_radius_is_inclusive_and_parallel_links_thin(spark, make_links, make_nodes):
    places = {1: (0, 0), 2: (100, 0), 3: (200, 0)}
    links = make_links(
        [
            link(1, 1, 2, [(0, 0), (50, 90), (100, 0)]),
            link(2, 1, 2, [(0, 0), (100, 0)]),
            link(3, 2, 3, [(100, 0), (200, 0)]),
            link(4, 3, 3, [(200, 0), (210, 0), (200, 0)]),
        ]
    )
    seeds = spark.createDataFrame([(1, 1)], "origin bigint, node bigint")
    arcs = R.undirected_arcs(links)
    got = R.reach_costs(seeds, arcs, make_nodes(places), 200.0).collect()
    assert {(r["node"], r["edge"], r["agg_cost"]) for r in got} == {(1, -1, 0.0), (2, 2, 100.0), (3, 3, 200.0)}


def test_paths_reach_targets_only_found_without_limit(spark, make_links, make_nodes):
    """A detour far longer than twice the straight line, and a target with no path."""
    places = {i: (i * 1000.0, 0.0) for i in range(12)}
    places.update({100: (0.0, 100.0), 200: (5.0, 500.0)})
    rows = [link(i, i, i + 1, [places[i], places[i + 1]]) for i in range(11)]
    rows.append(link(50, 11, 100, [places[11], places[100]]))
    pairs = spark.createDataFrame([(1, 0, 100), (2, 0, 200), (3, 3, 3)], "route_id bigint, o bigint, d bigint")
    got = T.paths(pairs, make_links(rows), make_nodes(places)).collect()
    way = sorted((r["pos"], r["node"]) for r in got if r["route_id"] == 1)
    assert [n for _, n in way] == [*range(12), 100]
    assert not [r for r in got if r["route_id"] == 2]
    assert [(r["pos"], r["node"]) for r in got if r["route_id"] == 3] == [(0, 3)]


@pytest.mark.parametrize("blocks", [4, 9, 1000])
def test_weak_components(spark, make_links, make_nodes, blocks):
    """Parts joined through several blocks; a chain, islands and a hub."""
    rnd = random.Random(blocks)
    places = {i: (rnd.uniform(0, 1000), rnd.uniform(0, 1000)) for i in range(80)}
    ends = [(i, i + 1) for i in range(30)] + [(40, j) for j in range(41, 55)] + [(60, 61), (62, 63), (63, 64), (64, 62)]
    links = make_links([link(k, a, b, [places[a], places[b]]) for k, (a, b) in enumerate(ends)])
    part = {r["node"]: r["component"] for r in R.weak_components(R.homed_arcs(R.directed_arcs(links), make_nodes(places), blocks)).collect()}
    want = {**{i: 0 for i in range(31)}, **{i: 40 for i in range(40, 55)}, 60: 60, 61: 60, 62: 62, 63: 62, 64: 62}
    assert part == want


def test_goal_in_another_component_is_not_searched(spark, make_links, make_nodes, monkeypatch):
    places = {i: (i * 100.0, 0.0) for i in range(40)}
    rows = [link(i, i, i + 1, [places[i], places[i + 1]]) for i in range(39) if i != 20]
    pairs = spark.createDataFrame([(1, 0, 39), (2, 39, 0)], "route_id bigint, o bigint, d bigint")
    searched = []
    monkeypatch.setattr(T, "search", lambda seeds, *a: searched.append(seeds.count()) or R.search(seeds, *a))
    assert T.paths(pairs, make_links(rows), make_nodes(places)).collect() == []
    assert searched == [0]


def test_entry_node_sides(spark, make_links):
    """A point below a link that runs east looks north at it: its left is the start."""
    links = make_links([link(1, 7, 8, [(0, 0), (100, 0)])])
    points = spark.createDataFrame([(1, 50.0, -20.0), (2, 50.0, 20.0)], "route_id bigint, x double, y double")
    snapped = T.snap(points, links, "route_id")
    start = {r["route_id"]: r["entry"] for r in T.entry_nodes(snapped, "left").collect()}
    goal = {r["route_id"]: r["entry"] for r in T.entry_nodes(snapped, "right").collect()}
    assert start == {1: 7, 2: 8} and goal == {1: 8, 2: 7}


def check_invariants(links, members, out):
    ids = [i for r in out for i in r["original_ids"]]
    assert sorted(ids) == sorted(str(r["id"]) for r in links.collect())
    total = sum(r["length"] for r in links.collect())
    assert abs(sum(r["length"] for r in out) - total) < 1e-6


def nodes_df(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "node bigint")


def test_chain_of_mixed_directions(spark, make_links):
    rows = [
        link(5, 1, 2, [(0, 0), (10, 0)], oneway="yes", name="X"),
        link(3, 3, 2, [(20, 0), (10, 0)], name="X / Y"),
        link(9, 3, 4, [(20, 0), (30, 0)], name=None, foot=None),
    ]
    links = make_links(rows, True)
    members = H.chain_members(links, nodes_df(spark, [2, 3]))
    got = {r["id"]: (r["chain"], r["pos"], r["forward"]) for r in members.collect()}
    # link 3 is the least and runs 3 -> 2, so the chain starts at node 4
    assert got == {9: (3, 0, False), 3: (3, 1, True), 5: (3, 2, False)}
    out = H.merge_chains(links, members).collect()
    check_invariants(links, members, out)
    row = out[0]
    assert (row["id"], row["source"], row["target"]) == (10, 4, 1)
    assert row["name"] == "X,X_Y" and row["foot"] == "yes" and row["oneway"] == "yes"
    assert row["original_ids"] == ["9", "3", "5"]
    assert [p["x"] for p in row["pts"]] == [30.0, 20.0, 10.0, 0.0]
    # plain sums keep the -1 mark; the safe costs block the direction as a whole
    assert row["cost"] == 30.0 and row["reverse_cost"] == 19.0
    assert row["cost_safe"] == -1.0 and row["reverse_cost_safe"] == 30.0


@pytest.mark.parametrize("size", [2, 3, 5, 8])
def test_closed_chain_becomes_one_loop(spark, make_links, size):
    import math

    at = [(math.cos(6.28 * i / size) * 100, math.sin(6.28 * i / size) * 100) for i in range(size)]
    rows = [link(20 - i, i, (i + 1) % size, [at[i], at[(i + 1) % size]]) for i in range(size)]
    links = make_links(rows, True)
    out = H.contract(links, nodes_df(spark, range(size))).collect()
    check_invariants(links, None, out)
    assert len(out) == 1 and out[0]["source"] == out[0]["target"] == 0


def test_long_chain_ring_and_loop_together(spark, make_links):
    rows = [link(i, i, i + 1, [(i, 0), (i + 1, 0)]) for i in range(40)]
    rows += [link(100 + i, 100 + i, 100 + (i + 1) % 7, [(i, 50), (i + 1, 50)]) for i in range(7)]
    rows += [link(200, 20, 20, [(20, 0), (20, 5), (20, 0)])]
    links = make_links(rows, True)
    merge = nodes_df(spark, [*range(1, 40), *range(100, 107)])
    out = H.contract(links, merge).collect()
    check_invariants(links, None, out)
    # the loop keeps its node, which cuts the long chain in two
    assert sorted((r["source"], r["target"]) for r in out) == [(0, 20), (20, 20), (20, 40), (100, 100)]


def test_contract_leaves_nothing_to_merge(spark, make_links):
    from pathloom.operators.network import degrees

    places, rows = random_network(11, n=50, m=55)
    links = make_links(rows, True)
    merge = degrees(links, loops=True).filter(F.col("degree") == 2).select("node")
    net = H.contract(links, merge)
    again = degrees(net, loops=True).filter(F.col("degree") == 2).select("node")
    assert H.joints(net, again).filter(F.col("one.id") != F.col("two.id")).isEmpty()
    check_invariants(links, None, net.collect())


def test_outline_of_a_footprint(spark):
    """A ring of cells with a hole, a cell that touches it at a corner, one apart."""
    from pathloom.operators import areas as A

    cells = [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)] + [(3, 3), (-5, -4)]
    rows = [(1, 10 * k + j, 100.0 * x + 20 + j, 100.0 * y + 50, 150.0) for k, (x, y) in enumerate(cells) for j in range(2)]
    reached = spark.createDataFrame(rows, "origin bigint, node bigint, x double, y double, agg_cost double")
    got = A.outlines(reached, bands=(200,)).collect()
    assert [(r["corners"], r["area"], r["perimeter"], len(r["rings"])) for r in got] == [(16, 100_000.0, 2400.0, 4)]
    rings = {tuple(sorted({(p["x"], p["y"]) for p in ring})) for ring in got[0]["rings"]}
    assert rings == {
        ((0, 0), (0, 300), (300, 0), (300, 300)), ((100, 100), (100, 200), (200, 100), (200, 200)),
        ((300, 300), (300, 400), (400, 300), (400, 400)), ((-500, -400), (-500, -300), (-400, -400), (-400, -300)),
    }
    assert all(ring[0] == ring[-1] for ring in got[0]["rings"])
