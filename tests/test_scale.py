"""Work and plans that must not grow faster than the tables."""

import random
import time

import pytest
from conftest import link
from pyspark.sql import functions as F

import __spark_entry__ as E
from catalog import network
from pathloom.operators import cells as C
from pathloom.operators import matrix as M
from pathloom.operators.ranks import counted_quantiles, quantiles
from pathloom.operators import selection as S
from pathloom.sources import network as N


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.fixture()
def tables(spark, make_links, tmp_path):
    """Links, zones and stops as written tables: small files, whatever comes of them."""
    rows = [(i, i, i + 1, [(i * 50, 0), (i * 50 + 50, 5)]) for i in range(40)]
    make_links([link(*r) for r in rows]).write.parquet(str(tmp_path / "links"))
    ring = [[(0.0, -100.0), (900.0, -100.0), (900.0, 100.0), (0.0, 100.0), (0.0, -100.0)]]
    spark.createDataFrame([(1, ring)], "zid bigint, rings array<array<struct<x:double,y:double>>>").write.parquet(str(tmp_path / "zones"))
    spark.createDataFrame([(i, i * 100.0, 3.0) for i in range(20)], "stop_id bigint, x double, y double").write.parquet(str(tmp_path / "stops"))
    return tuple(spark.read.parquet(str(tmp_path / t)) for t in ("links", "zones", "stops"))


def test_listings_by_cell_are_not_broadcast(tables):
    links, zones, stops = tables
    for df in (
        C.points_near_lines(stops, links, "stop_id", "id", 100.0),
        C.points_in_zones(stops, zones, ["zid"], within=50.0),
        C.ring_distance(links, zones, "id", ["zid"], 50.0),
        C.lines_meeting(links, links, "id", "id"),
    ):
        assert "BroadcastHashJoin" not in plan(df)


def test_links_of_a_selection_are_not_broadcast(tables):
    links, zones, stops = tables
    for df in (S.stop_links(links, zones, stops), S.zone_near(links, zones), S.first_links(links, zones, stops)):
        assert "BroadcastHashJoin" not in plan(df)
    assert S.stop_links(links, zones, stops).count() > 0


def test_nodes_are_not_broadcast(spark):
    assert "BroadcastHashJoin" not in plan(N.links(spark, "/root/testdata/sf0.001"))


def test_cells_of_a_segment_come_once(spark):
    r = random.Random(3)
    rows = [tuple(r.choice([0.0, 250.0, r.uniform(-3e3, 3e3)]) for _ in range(4)) for _ in range(300)]
    at = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    df = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double")
    for grow in (0.0, 60.0, 400.0):
        got = df.select(*at, C.segment_cells(*at, 250.0, grow).alias("c")).collect()
        for row in got:
            x1, y1, x2, y2, cells = row
            cells = [tuple(c) for c in cells]
            steps = max(-int(-(((x2 - x1) ** 2 + (y2 - y1) ** 2) ** 0.5) // 250.0), 1)
            want = set()
            for i in range(steps):
                (ax, ay), (bx, by) = ((x1 + k / steps * (x2 - x1), y1 + k / steps * (y2 - y1)) for k in (i, i + 1))
                s = grow + 1e-6
                want |= {
                    (cx, cy)
                    for cx in range(int((min(ax, bx) - s) // 250), int((max(ax, bx) + s) // 250) + 1)
                    for cy in range(int((min(ay, by) - s) // 250), int((max(ay, by) + s) // 250) + 1)
                }
            assert len(cells) == len(set(cells)) and set(cells) == want


def test_cells_of_a_long_segment_take_linear_time(spark):
    """A zone edge of 8,000 km: 32,000 steps, which were compared each with each other."""
    at = [F.lit(v) for v in (-50.0, -50.0, 750.0, 8e6)]
    start = time.time()
    got = spark.range(1).select(F.explode(C.segment_cells(*at, 250.0, 50.0)).alias("c")).agg(F.count(F.lit(1)), F.count_distinct("c")).first()
    assert got[0] == got[1] > 32_000
    assert time.time() - start < 60


def test_quantiles_by_counting(spark):
    """The same as by sorting: ties, gaps, tiny and huge values, nulls, few rows, none."""
    r = random.Random(5)
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    for values in (
        [r.uniform(0, 1e6) for _ in range(2000)],
        [float(r.choice([1, 1, 1, 2, 7])) for _ in range(500)] + [None] * 50,
        [10.0 ** r.randint(-300, 300) for _ in range(300)],
        [1e9, 1e9 + 1e-6, 1e9 + 2e-6, -5.0],
        [4.0],
        [0.0, 1e308, -1e308, 3.0, 4.0],
        [1.0, float("nan"), 2.0, 5.0, 3.0],
        [None],
        [],
    ):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, value double").repartition(5)
        ends = df.agg(F.count("value").alias("count"), F.min("value").alias("min"), F.max("value").alias("max")).first()
        got, want = counted_quantiles(df, "value", ["id"], probs, ends), quantiles(df, "value", ["id"], probs)
        assert got.columns == want.columns and str(got.collect()) == str(want.collect()), values[:5]


def test_summaries_do_not_write_or_shuffle_the_full_matrix(spark, monkeypatch):
    """Rows of every pair are counted where they are made: no exchange has them."""

    def written(*_):
        raise AssertionError("the full matrix is written")

    monkeypatch.setattr(network, "final_matrix", written)
    for name in ("a10_describe", "a11_binned_counts", "m4_diagonal", "m_checks", "s10_summary_csv"):
        assert E.queries()[name](spark, E.SMOKE_DIR).collect()
    near = spark.createDataFrame([(i, float(i % 7), float(i)) for i in range(30)], "centroid_id bigint, x double, y double")
    known = spark.createDataFrame([(i, j, 50.0) for i in range(30) for j in range(5)], "origin bigint, target bigint, value double")
    factor = spark.createDataFrame([(1.5, 1.0)], "factor double, low double")
    full = M.combined(known, near, factor, written=False)
    with M.setting(spark, M.TOGETHER_BY_SOME_KEYS, "false"):
        text = full.agg(F.sum("value"))._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in text.splitlines() if "Join" in line]
    assert len(joins) == 2 and all("ShuffledHashJoin" in line for line in joins)
    assert "Sort [" not in text and text.count("hashpartitioning(tile") == 3 == text.count("Exchange hashpartitioning")
    kept = M.combined(known, near, factor)
    assert sorted(kept.collect()) == sorted(full.collect()) and kept.count() == 900
