import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from pathloom.llm.hard_negatives import ORACLE, hard_negatives, op13_hard_negatives

ROWS = "vec_id bigint, label int, q array<bigint>"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, asks, top=5, low=80, high=100):
    out = []
    for i, (a, la, qa) in enumerate(rows):
        if not asks(a):
            continue
        score = [(-sum(x * y for x, y in zip(qa, q)), b, j, lb) for j, (b, lb, q) in enumerate(rows) if j != i]
        score.sort()
        for p, pid, *_ in [s for s in score if s[3] == la][:top]:
            fits = [s for s in score if s[3] != la and low * -p <= 100 * -s[0] <= high * -p][:top]
            out += [(a, pid, k, b, -p, -n) for k, (n, b, *_) in enumerate(fits, 1)]
    return sorted(out)


def rows_of(n, d, seed, spread=40):
    rnd = random.Random(seed)
    return [(i, rnd.randrange(4), [rnd.randint(-spread, spread) + 15 for _ in range(d)]) for i in range(n)]


def run(spark, rows, **more):
    got = hard_negatives(spark.createDataFrame(rows, ROWS).repartition(3), F.col("vec_id") % 10 == 0, **more)
    assert tuple(got.columns) == NAMES
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("more", [{}, {"block": 7, "chunk_cells": 40}, {"top": 2, "low": 50, "high": 90, "block": 30}])
def test_against_brute_force(spark, more):
    rows = rows_of(300, 19, 1)
    want = brute(rows, lambda a: a % 10 == 0, **{k: v for k, v in more.items() if k in ("top", "low", "high")})
    assert run(spark, rows, **more) == want and len(want) > 50


def test_ties_and_a_hot_vector(spark):
    """A third of the rows are one vector; small entries make many equal scores."""
    rows = [(i, lab, [1, 2, 0, 1] if i % 3 == 0 else [x % 3 for x in q[:4]]) for i, lab, q in rows_of(400, 4, 2)]
    assert run(spark, rows, block=32) == brute(rows, lambda a: a % 10 == 0)


def test_large_components(spark):
    """Scores beyond the exact range of doubles."""
    rows = [(i, lab, [x * 2_000_003 + i for x in q]) for i, lab, q in rows_of(80, 9, 3)]
    assert run(spark, rows, block=16) == brute(rows, lambda a: a % 10 == 0)


def test_rows_that_take_no_part(spark):
    rows = rows_of(120, 5, 4)
    odd = [(None, 1, [90] * 5), (990, None, [90] * 5), (980, 1, None), (970, 1, [None] * 5), (960, 1, [1 << 40] * 5), (950, 1, [90] * 6), (940, 1, [])]
    assert run(spark, rows + odd) == brute(rows, lambda a: a % 10 == 0)
    assert run(spark, []) == [] and run(spark, odd[:1]) == [] and run(spark, rows[1:9]) == []


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = rows_of(60, 6, 5)
    twice = rows + [(20, *rows[20][1:]), (30, rows[31][1], rows[31][2])]
    got = run(spark, twice)
    want = brute(twice, lambda a: a % 10 == 0)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]


def test_query_on_odd_embeddings(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(8)], rnd.randrange(10)) for i in range(350)]
    rows += [(400, None, 1), (500, [math.nan] * 8, 1), (600, [math.inf] * 8, 2), (700, [0.5] * 8, None), (800, [None] * 8, 3)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns({"q": F.lit(1), "key": F.lit("a"), "score": F.lit(2.0)})
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(map(tuple, op13_hard_negatives(spark, str(tmp_path)).collect())) == sorted(con.sql(ORACLE).fetchall())
