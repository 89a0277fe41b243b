"""Selection, oneway and repair rules on single cases; ranks, matrices and files."""

import statistics

import pytest
from conftest import link
from pyspark.sql import functions as F

from pathloom.operators import areas as A
from pathloom.operators import matrix as M
from pathloom.operators import network as O
from pathloom.operators import oneway as W
from pathloom.operators import ranks as K
from pathloom.operators import repair as X
from pathloom.operators import selection as S
from pathloom.plans import simplify as P
from pathloom.sources import files


def ids(df, col="id"):
    return sorted(r[col] for r in df.collect())


def line(*xs, y=0):
    return [(x, y) for x in xs]


@pytest.fixture
def no_fix(spark):
    return spark.createDataFrame([], "node bigint, id1 bigint, id2 bigint")


def test_unknown_mode_and_null_attributes(make_links):
    with pytest.raises(ValueError):
        O.mode("boat")
    rows = [link(1, 1, 2, line(0, 1)), link(2, 1, 2, line(0, 1), foot=None), link(3, 1, 2, line(0, 1), rail=None)]
    assert ids(O.for_mode(make_links(rows), "walk")) == [1]
    assert ids(O.for_mode(make_links(rows), "drive")) == [1, 2]
    assert O.mode("walk").radius_m == 24000 and O.mode("cycle").radius_m == 60000


def test_conflict_pair_becomes_fix_node(spark, make_links):
    rows = [
        link(1, 1, 2, line(0, 10), oneway="yes"),
        link(2, 3, 2, line(30, 10), oneway="-1"),
        link(3, 3, 4, line(30, 40), oneway="yes"),
        link(4, 3, 5, line(30, 50), oneway="yes"),
        link(5, 6, 7, line(60, 70), oneway="yes", name="B"),
        link(6, 7, 8, line(70, 80), oneway="no", name="C"),
    ]
    links = make_links(rows)
    inside = links.select("id")
    pairs = W.surviving_pairs(links, inside, links)
    assert [(r["node"], r["id1"], r["id2"]) for r in W.fix_nodes(pairs).collect()] == [(2, 1, 2)]


def test_junction_partner_takes_link_out(make_links):
    """Link 1 ends at a junction where link 3 runs the other way: all its pairs go."""
    rows = [
        link(1, 2, 9, line(10, 0), oneway="yes"),
        link(2, 1, 2, line(20, 10), oneway="-1"),
        link(3, 5, 9, line(30, 0), oneway="no"),
        link(4, 9, 7, line(0, -50)),
    ]
    links = make_links(rows)
    inside = links.select("id")
    assert ids(W.junction_conflicts(links, inside, links)) == [1]
    assert W.surviving_pairs(links, inside, links).isEmpty()


def test_align_oneway_swaps_the_shorter(spark, make_links):
    rows = [link(1, 1, 2, line(0, 10), oneway="yes"), link(2, 2, 3, line(10, 100), oneway="-1")]
    fix = spark.createDataFrame([(2, 1, 2)], "node bigint, id1 bigint, id2 bigint")
    got = {r["id"]: r for r in W.align_oneway(make_links(rows), fix).collect()}
    assert got[1]["oneway"] == "-1" and (got[1]["cost"], got[1]["reverse_cost"]) == (-1.0, 10.0)
    assert got[2]["oneway"] == "-1" and got[2]["cost"] == -1.0


def test_fix_nodes_in_a_row_are_settled_in_order(spark, make_links):
    rows = [
        link(1, 1, 2, line(0, 10), oneway="yes"),
        link(2, 2, 3, line(10, 100), oneway="-1"),
        link(3, 3, 4, line(100, 130), oneway="yes"),
    ]
    fix = spark.createDataFrame([(2, 1, 2), (3, 2, 3)], "node bigint, id1 bigint, id2 bigint")
    links = make_links(rows, True)
    assert ids(W.ready_fixes(links, fix), "node") == [2]
    got = P.settle_oneway(links, fix).collect()
    assert len(got) == 1 and got[0]["oneway"] == "-1" and got[0]["length"] == 130.0


def test_lost_junction_is_restored(spark, make_links, make_nodes, no_fix):
    """A side road ends in the middle of a merged link: the link is taken apart there."""
    places = {1: (0, 0), 2: (50, 0), 3: (100, 0), 4: (50, 80), 5: (0, 50), 6: (150, 0), 7: (-50, 0)}
    edges = make_links(
        [
            link(1, 1, 2, [places[1], places[2]]),
            link(2, 2, 3, [places[2], places[3]]),
            link(3, 4, 2, [places[4], places[2]]),
            link(4, 1, 7, [places[1], places[7]]),
            link(5, 3, 6, [places[3], places[6]]),
            link(6, 1, 5, [places[1], places[5]]),
            link(7, 3, 5, [places[3], places[5]]),
            link(8, 4, 5, [places[4], places[5]]),
        ],
        True,
    )
    merged = edges.filter("id in (1, 2)")
    from pathloom.operators.chains import contract

    wrong = contract(merged, spark.createDataFrame([(2,)], "node bigint")).withColumn("id", F.col("id") + 100)
    net = wrong.unionByName(
        edges.filter("id > 2").withColumns({"cost_safe": F.col("cost"), "reverse_cost_safe": F.col("reverse_cost")})
    )
    counted = W.counted_degrees(net, no_fix)
    nodes = make_nodes(places)
    every = net.select("id")
    got = X.lost_junctions(net, nodes, counted, every).collect()
    assert [(r["id"], r["node"]) for r in got] == [(3, 2)]
    assert not X.lost_junctions(net, nodes, counted, every.filter("id <> 3")).collect()
    far = net.filter("id = 3").select(F.when(F.col("source") == 2, F.col("target")).otherwise(F.col("source")).alias("node"))
    tip = counted.join(far, "node", "left_anti")  # the far end of the dead end is set aside for a fix
    assert not X.lost_junctions(net, nodes, tip, every).collect()
    ring = [(-500.0, -500.0), (500.0, -500.0), (500.0, 500.0), (-500.0, 500.0), (-500.0, -500.0)]
    zones = spark.createDataFrame([(1, [ring])], "zid bigint, rings array<array<struct<x:double,y:double>>>")
    stops = spark.createDataFrame([], "stop_id bigint, x double, y double")
    fixed = P.repair_junctions(net, edges.drop("original_ids"), nodes, zones, stops, no_fix)
    assert {1, 2} <= set(ids(fixed))
    assert sorted(i for r in fixed.collect() for i in r["original_ids"]) == [str(i) for i in range(1, 9)]


def test_crossing_without_a_common_end(spark, make_links, make_nodes, no_fix):
    places = {1: (0, 0), 2: (100, 0), 3: (50, -50), 4: (50, 50), 5: (50, 0)}
    rows = [link(1, 1, 2, line(0, 100)), link(2, 3, 4, [(50, -50), (50, 50)]), link(3, 1, 3, [(0, 0), (50, -50)])]
    links = make_links(rows, True)
    counted = W.counted_degrees(links, no_fix)
    got = X.wrong_crossings(links, make_nodes(places), counted, no_fix, links.select("id"))
    assert sorted((r["node"], r["id1"], r["id2"]) for r in got.collect()) == [(5, 1, 2), (5, 2, 1)]


def test_islands_and_loops(spark, make_links, no_fix):
    rows = [
        link(1, 1, 2, line(0, 100)),
        link(2, 3, 4, line(500, 600), highway="trunk"),
        link(3, 5, 5, [(0, 50), (10, 60), (0, 50)]),
        link(4, 6, 6, [(300, 50), (310, 60), (300, 50)]),
    ]
    links = make_links(rows)
    stops = spark.createDataFrame([(1, 301.0, 51.0)], "stop_id bigint, x double, y double")
    assert ids(X.island_links(links, W.counted_degrees(links, no_fix), links.select("id"))) == [1]
    assert ids(X.idle_loops(links, stops)) == [3]
    assert ids(X.stop_loops(links, stops)) == [4]


def test_restore_keeps_single_member_links(make_links):
    """A wrongly touched link that was never merged stays in the network."""
    edges = make_links([link(1, 1, 2, line(0, 10)), link(2, 2, 3, line(10, 20))])
    net = make_links([link(1, 1, 2, line(0, 10)), link(2, 2, 3, line(10, 20))], True)
    assert ids(X.restore_originals(net, edges, net.select("id"))) == [1, 2]


def test_oneway_change_counts_null_as_a_value(spark, make_links):
    rows = [
        link(1, 1, 2, line(0, 10), oneway="yes"),
        link(2, 2, 3, line(10, 20)),
        link(3, 3, 4, line(20, 30)),
        link(4, 4, 5, line(30, 40), oneway="no"),
    ]
    links = make_links(rows)
    counted = O.degrees(links)
    got = X.oneway_changes(links, links.filter("id < 3").select("id"), counted)
    assert ids(got, "node") == [2]


def test_names_inside_names(spark):
    long = [(1, "Old Main Road / X"), (1, "Park Road / Y"), (2, "Main Road / Z")]
    short = [(1, "Main Road"), (1, "ark Road"), (1, "Road / Y"), (1, "None"), (2, "Main Road / Z / W")]
    schema = "zid bigint, name string"
    got = S.names_containing(spark.createDataFrame(long, schema), spark.createDataFrame(short, schema))
    want = {(z, a, b) for z, a in long for y, b in short if z == y and b in a}
    assert {(r["zid"], r["long"], r["part"]) for r in got.collect()} == want and len(want) == 3


def test_numbered_with_a_hot_group(spark):
    rows = [(i % 3 if i % 3 else 0, float(i % 17), i) for i in range(500)] + [(0, 1.0, 1000 + i) for i in range(500)]
    df = spark.createDataFrame(rows, "g bigint, v double, k bigint")
    got, n = K.numbered(df, ["v", "k"], ["g"])
    assert n == 1000
    seen = {}
    for g, v, k in sorted(rows):
        seen[g] = seen.get(g, 0) + 1
        rows_key = (g, k)
        assert rows_key not in seen
        seen[rows_key] = seen[g]
    assert all(seen[r["g"], r["k"]] == r["rn"] for r in got.collect())


def test_quantiles_are_exact(spark):
    values = [float((i * 7919) % 1009) for i in range(400)] + [5.0] * 200
    df = spark.createDataFrame(list(enumerate(values)), "k bigint, v double")
    row = K.quantiles(df, "v", ["k"], {"a": 0.25, "b": 0.5, "c": 0.75}).first()
    q = statistics.quantiles(values, n=4, method="inclusive")
    assert [row["a"], row["b"], row["c"]] == pytest.approx(q)


@pytest.fixture
def near(spark):
    rows = [(1, 10, 0.0, 0.0, 0.0), (2, 20, 0.0, 30.0, 40.0), (3, 20, 1.0, 30.0, 40.0), (4, 40, 0.0, 300.0, 400.0)]
    return spark.createDataFrame(rows, "centroid_id bigint, node_id bigint, dist double, x double, y double")


@pytest.fixture
def network_matrix(spark):
    rows = [(1, 1, 0.0), (2, 2, 0.0), (3, 3, 0.0), (2, 3, 0.0), (3, 2, 0.0), (1, 2, 75.0), (2, 1, 75.0), (1, 3, 75.0), (3, 1, 80.0)]
    return spark.createDataFrame(rows, "origin bigint, target bigint, value double")


def test_matrix_is_filled_and_checked(near, network_matrix):
    """Two centroids on one node, and one with no network cost at all."""
    factor = M.wiggle_factor(network_matrix, near)
    mean = (1.5 + 1.5 + 1.5 + 1.6) / 4
    assert factor.first()["factor"] == pytest.approx(mean)
    full = {(r["origin"], r["target"]): r["value"] for r in M.combined(network_matrix, near, factor).collect()}
    assert len(full) == 16
    assert full[4, 1] == pytest.approx(500 * mean) and full[4, 4] == 0.0 and full[3, 1] == 80.0
    sym = M.symmetry(network_matrix).first()
    assert (sym["max_abs_diff"], sym["asymmetric_pairs"]) == (5.0, 1)
    top = M.largest_ratios(network_matrix, near, 1).first()
    assert (top["origin"], top["target"]) in {(1, 2), (1, 3)}


def test_too_short_network_distance_is_an_error(spark, near):
    rows = spark.createDataFrame([(1, 2, 49.0)], "origin bigint, target bigint, value double")
    with pytest.raises(Exception, match="shorter than the straight line"):
        M.wiggle_factor(rows, near).collect()
    assert M.wiggle_factor(rows, near, strict=False).first()["low"] < 1


def test_double_pair_is_an_error(spark):
    rows = [(1, 2, 5.0), (1, 2, 6.0)]
    od = spark.createDataFrame(rows, "start_centroid bigint, target_centroid bigint, agg_cost double")
    with pytest.raises(Exception, match="occurs twice"):
        M.long_matrix(od).collect()


def test_empty_bins_are_shown(spark):
    rows = [(1, 1, 0.0), (1, 2, 1000.0), (1, 3, 1000.1), (1, 4, 90000.0)]
    got = M.bin_counts(spark.createDataFrame(rows, "origin bigint, target bigint, value double"))
    assert [(r["bin"], r["count"]) for r in got.orderBy("position").collect()] == [
        ("0-1", 2), ("1-2", 1), ("2-5", 0), ("5-9", 0), ("9-14", 0), ("14-20", 0), (">20", 1),
    ]


def test_csv_errors_are_not_silent(spark, tmp_path):
    good = tmp_path / "stop_times.txt"
    header = ",".join(c.split()[0] for c in files.STOP_TIME_COLUMNS.split(", "))
    good.write_text(header + '\nt1,25:10:00,25:10:00,"s,1",3,"say ""hi""",,,,\n', encoding="utf8")
    row = files.read_stop_times(spark, str(good)).first()
    assert (row["stop_id"], row["stop_sequence"], row["arrival_time"]) == ("s,1", 3, "25:10:00")
    assert row["stop_headsign"] == 'say "hi"'
    bad = tmp_path / "bad.txt"
    bad.write_text(header + "\nt1,a,b,c,three,,,,,\n")
    with pytest.raises(Exception):
        files.read_stop_times(spark, str(bad)).collect()
    with pytest.raises(ValueError):
        files.require_columns(spark.range(1), ["zone_id"], "zones")


def test_hull_holds_every_point():
    import numpy as np

    rnd = np.random.default_rng(1)
    pts = rnd.integers(0, 50, size=(300, 2)).astype(float)
    corner = A.hull(pts)
    nxt = np.roll(corner, -1, axis=0)
    for (ax, ay), (bx, by) in zip(corner, nxt):
        assert ((bx - ax) * (pts[:, 1] - ay) - (by - ay) * (pts[:, 0] - ax) >= 0).all()


def test_hull_of_strips_is_the_hull(spark):
    import numpy as np

    rnd = np.random.default_rng(2)
    pts = rnd.uniform(0, 2000, size=(200, 2))
    rows = [(1, i, float(x), float(y), 100.0) for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(rows, "origin bigint, node bigint, x double, y double, agg_cost double")
    got = A.hulls(df, bands=(200,)).first()
    assert got["corners"] == len(A.hull(pts))
