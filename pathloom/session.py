"""Session settings and the shared scratch area for iterative jobs.

Iterative operators cut their lineage by writing each round as a Parquet table
below the folder the cluster names in ``spark.checkpoint.dir``.  A written
table outlives any executor, so a lost executor costs one task, not the loop.
"""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "pathloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; all stay overridable."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by all executors: ``spark.checkpoint.dir``
    of the session, or else the folder set by ``setCheckpointDir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def local_scratch(spark: SparkSession) -> None:
    """Give a session on one machine a temporary folder, where none is set."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and re.match(r"local($|\[)", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pathloom-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "step", path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_with(
    df: DataFrame, name: str = "step", path: str | None = None, **metrics: Column
) -> tuple[DataFrame, dict]:
    """Like :func:`materialise`, with aggregates gathered by the same job.

    The loop controls of the iterative operators (row count, least distance)
    come from here, so that a round costs one job and not two.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    seen = Observation()
    wanted = {"n": F.count(F.lit(1)), **metrics}
    observed = df.observe(seen, *[c.alias(k) for k, c in wanted.items()])
    observed.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the plans made inside the block."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_functions(module: str) -> None:
    """Send the functions of a module to the Python workers with the task itself,
    so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
