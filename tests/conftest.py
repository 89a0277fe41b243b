import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pathloom.session import build_session, local_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="3", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    local_scratch(session)
    yield session
    session.stop()


LINK_SCHEMA = (
    "id bigint, name string, foot string, highway string, railway string, rail string, ferry string, "
    "toll string, junction string, route string, ford string, bridge string, tunnel string, "
    "service string, oneway string, source bigint, target bigint, length double, cost double, "
    "reverse_cost double, pts array<struct<x:double,y:double>>"
)


def link(i, source, target, pts, **more):
    """A link row; the length follows from the points."""
    length = sum(
        ((ax - bx) ** 2 + (ay - by) ** 2) ** 0.5 for (ax, ay), (bx, by) in zip(pts, pts[1:])
    )
    one = more.get("oneway")
    row = {c.split()[0]: None for c in LINK_SCHEMA.split(", ")}
    row.update(id=i, source=source, target=target, name="A Road", foot="yes", rail="no", highway="residential")
    row.update(
        length=length,
        cost=-1.0 if one == "-1" else length,
        reverse_cost=-1.0 if one == "yes" else length,
        pts=[(float(x), float(y)) for x, y in pts],
    )
    row.update(more)
    return tuple(row.values())


@pytest.fixture(scope="session")
def make_links(spark):
    def make(rows, with_ids=False):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, LINK_SCHEMA)
        return df.withColumn("original_ids", F.array(F.col("id").cast("string"))) if with_ids else df

    return make


@pytest.fixture(scope="session")
def make_nodes(spark):
    def make(places):
        rows = [(k, float(x), float(y)) for k, (x, y) in places.items()]
        return spark.createDataFrame(rows, "nodeid bigint, x double, y double")

    return make
