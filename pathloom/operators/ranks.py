"""Row numbers and exact quantiles without a one-task sort."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from pathloom.session import materialise_with, shuffle_width

# Parts that a range of values is counted in.
PARTS = 1 << 12


def numbered(
    df: DataFrame, order: list[str], within: list[str] | None = None, name: str = "rn"
) -> tuple[DataFrame, int]:
    """Row numbers from 1 in the total order ``order``, per group of ``within``.

    Rows are split by value range, counted per split, numbered inside each split
    and shifted by the rows before it, so that neither a global order nor one
    huge group meets in a single task.  Returns the rows and their count.
    """
    group = list(within or [])
    width = shuffle_width(df.sparkSession)
    split = df.repartitionByRange(width, *group, *order).withColumn("_p", F.spark_partition_id())
    split, seen = materialise_with(split, "ranges")
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_p").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shift = (
        split.groupBy(*group, "_p")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_s", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inner = Window.partitionBy(*group, "_p").orderBy(*order)
    out = (
        split.withColumn("_r", F.row_number().over(inner))
        .join(shift, [*group, "_p"])
        .withColumn(name, (F.col("_r") + F.col("_s")).cast("bigint"))
    )
    return out.select(*df.columns, name), seen["n"]


def quantiles(df: DataFrame, value: str, key: list[str], probs: dict[str, float]) -> DataFrame:
    """One row: exact quantiles by linear interpolation between neighbours."""
    rows, n = numbered(df.filter(F.col(value).isNotNull()).select(*key, value), [value, *key])
    cols = []
    for name, p in probs.items():
        at = p * (n - 1)
        lo, hi = math.floor(at), math.ceil(at)

        def pick(i: int):
            return F.max(F.when(F.col("rn") == i + 1, F.col(value)))

        cols.append((pick(lo) + (pick(hi) - pick(lo)) * (at - lo)).alias(name))
    return rows.agg(*cols)


def counted_quantiles(df: DataFrame, value: str, key: list[str], probs: dict[str, float], ends: Row) -> DataFrame:
    """The row of :func:`quantiles`, for more rows than should be sorted or shuffled.

    ``ends`` holds the count, min and max of the values.  A pass counts the values by
    parts of the ranges that hold the ranks asked for, and the parts that hold them are
    the ranges of the next pass, until a rank is known: its part has one value only, or
    the rank is that of its least or greatest.  Nothing is shuffled but counts.
    """
    v, n = F.col(value), ends["count"]
    at = {name: p * (n - 1) for name, p in probs.items()}
    ranks = sorted({r for a in at.values() for r in (math.floor(a), math.ceil(a))} if n else [])
    found: dict[int, float] = {}
    spans = [(ends["min"], ends["max"], 0)] if n else []  # least, greatest, values before
    while spans:
        width = [(hi - lo) / PARTS for lo, hi, _ in spans]
        if not all(math.isfinite(w) and (w or lo == hi) for w, (lo, hi, _) in zip(width, spans)):
            return quantiles(df, value, key, probs)
        place = F.lit(None).cast("int")
        for i, (lo, hi, _) in enumerate(spans):
            part = F.least(F.floor((v - lo) / width[i]), F.lit(PARTS - 1)).cast("int") if lo < hi else F.lit(0)
            place = F.when(v.between(lo, hi), i * PARTS + part).otherwise(place)
        parts = df.select(v.alias("v"), place.alias("p")).filter(F.col("p").isNotNull()).groupBy("p")
        counts = parts.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).collect()
        before, narrow = [s[2] for s in spans], []
        for row in sorted(counts, key=lambda r: r["p"]):
            first = before[row["p"] // PARTS]
            last = first + row["n"] - 1
            before[row["p"] // PARTS] = last + 1
            here = [r for r in ranks if first <= r <= last and r not in found]
            found |= {r: row["lo"] if r == first else row["hi"] for r in here if r in (first, last) or row["lo"] == row["hi"]}
            if any(r not in found for r in here):
                narrow.append((row["lo"], row["hi"], first))
        spans = narrow

    def quantile(a: float) -> float | None:
        lo, hi = found.get(math.floor(a)), found.get(math.ceil(a))
        return None if lo is None or hi is None else lo + (hi - lo) * (a - math.floor(a))

    row = tuple(quantile(a) for a in at.values())
    return df.sparkSession.createDataFrame([row], ", ".join(f"{name} double" for name in probs))
