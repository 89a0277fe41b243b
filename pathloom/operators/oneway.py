"""Oneway conflicts between links that would be merged.

A conflict is a pair of links with different oneway values that share an end.
Pairs that meet at a junction are all dropped by the rules, so they are never
listed: whether a link has such a partner is worked out from counts per
(node, name, oneway).  Pairs are listed only at nodes with two link ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.operators.network import degrees, ends
from pathloom.session import materialise

# The oneway values that take part in a conflict.
DIRECTED = ("-1", "yes", "no")


def conflict_pairs(links: DataFrame) -> DataFrame:
    """node, id1, id2 and the attributes of both: ordered pairs of links that differ
    in oneway and meet end to end, at a node that has two link ends in all.  Pairs
    that meet at a junction are counted by :func:`conflict_counts`."""
    two = degrees(links, loops=True).filter(F.col("degree") == 2).select("node")
    cols = ["id", "name", "oneway", "source", "target", "length", "cost", "reverse_cost"]
    at = ends(links.filter(F.col("oneway").isin(*DIRECTED)), *cols).join(two, "node", "left_semi")
    row = F.struct(*cols)
    pair = at.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min(row).alias("p"), F.max(row).alias("q")
    )
    pair = pair.filter((F.col("n") == 2) & (F.col("p.oneway") != F.col("q.oneway")))

    def ordered(a: str, b: str) -> Column:
        names = [F.col(f"{a}.{c}").alias(c + "1" if c not in ("cost", "reverse_cost") else c) for c in cols]
        other = [F.col(f"{b}.{c}").alias(c + "2") for c in ("id", "name", "oneway", "source", "target", "length")]
        return F.struct("node", *names, *other)

    both = F.explode(F.array(ordered("p", "q"), ordered("q", "p"))).alias("r")
    return pair.filter(F.col("p.id") != F.col("q.id")).select(both).select("r.*")


def conflict_counts(links: DataFrame, edges: DataFrame, in_zone: DataFrame) -> DataFrame:
    """id, pairs, pruned, apart, kept: for each link that would come first in a pair,
    its partners by the full pair rule, whichever junction they meet at.

    A pair is two links that differ in oneway and share a node, the first having two
    link ends at one of its own nodes.  ``pruned`` are the partners left by the name
    and zone rules, ``apart`` those of them that are no junction at both ends, ``kept``
    those that do not meet the link at a junction as the junction rules say.  Partners
    are counted per node and oneway and never listed.
    """
    deg = degrees(links, loops=True)
    rows = (
        links.filter(F.col("oneway").isin(*DIRECTED))
        .join(deg.select(F.col("node").alias("source"), F.col("degree").alias("ds")), "source")
        .join(deg.select(F.col("node").alias("target"), F.col("degree").alias("dt")), "target")
        .join(in_zone.select("id", F.lit(True).alias("zone")), "id", "left")
        .join(edges.select("id", F.lit(True).alias("edge")), "id", "left")
    )
    zone, trunk = F.coalesce("zone", F.lit(False)), F.coalesce(F.col("highway") == "trunk", F.lit(False))
    lead = ((F.col("ds") == 2) | (F.col("dt") == 2)).alias("lead")
    allowed = (zone | F.col("edge").isNull() | trunk).alias("allowed")
    follows = (~(zone & F.coalesce(F.col("junction") == "roundabout", F.lit(False)))).alias("follows")
    apart = (~((F.col("ds") > 2) & (F.col("dt") > 2))).alias("apart")
    rows = materialise(
        rows.select("id", "name", "oneway", "source", "target", "ds", "dt", lead, allowed, follows, apart), "directed"
    )

    def place(kind: str, p: Column, q: Column | None = None) -> Column:
        return F.struct(F.lit(kind).alias("kind"), p.alias("p"), (F.lit(-1).cast("bigint") if q is None else q).alias("q"))

    s, t = F.col("source"), F.col("target")
    loop = s == t
    # where a link can be met: at a node, at both its nodes, by its source
    met = F.array_distinct(F.array(place("node", s), place("node", t)))
    both = F.when(~loop, place("both", F.least(s, t), F.greatest(s, t)))
    met = F.filter(F.concat(met, F.array(both, place("source", s))), lambda m: m.isNotNull())
    kinds = {"pairs": F.lit(True), "pruned": F.col("follows"), "apart": F.col("follows") & F.col("apart")}
    at = rows.select("oneway", "name", "follows", "apart", F.explode(met).alias("m")).select("*", "m.*").drop("m")

    def counts(*keys: str) -> DataFrame:
        total = [F.count(F.when(cond & (F.col("oneway") == v), 1)).alias(f"{k}{i}") for k, cond in kinds.items() for i, v in enumerate(DIRECTED)]
        return at.groupBy("kind", "p", "q", *keys).agg(*total)

    def others(prefix: str, frame: str) -> Column:
        total = F.lit(0)
        for i, v in enumerate(DIRECTED):
            total = total + F.when(F.col("oneway") == v, 0).otherwise(F.coalesce(F.col(f"{frame}.{prefix}{i}"), F.lit(0)))
        return total

    # what a first link asks: partners at its nodes, less those met at both; the junction
    # rules take away those at a junction it starts at, or that start where it ends
    ask = F.array(
        F.struct(place("node", s).alias("m"), F.lit(1).alias("any"), F.when(F.col("ds") > 2, 1).otherwise(0).alias("bad")),
        F.when(~loop, F.struct(place("node", t).alias("m"), F.lit(1).alias("any"), F.lit(0).alias("bad"))),
        F.when(~loop, F.struct(place("both", F.least(s, t), F.greatest(s, t)).alias("m"), F.lit(-1).alias("any"), F.lit(0).alias("bad"))),
        F.when(~loop & (F.col("dt") > 2) & (F.col("ds") <= 2), F.struct(place("source", t).alias("m"), F.lit(0).alias("any"), F.lit(1).alias("bad"))),
    )
    first = rows.filter("lead").select("id", "name", "oneway", "allowed", F.explode(F.filter(ask, lambda a: a.isNotNull())).alias("a"))
    first = first.select("id", "name", "oneway", "allowed", "a.any", "a.bad", "a.m.*").alias("f")
    every, named, nameless = counts().alias("e"), at_names(counts("name")).alias("n"), counts("name").filter(F.col("name").isNull()).alias("u")
    here = ["kind", "p", "q"]
    on = lambda o: F.expr(" AND ".join(f"f.{c} = {o}.{c}" for c in here))
    joined = (
        first.join(every, on("e"), "left").join(named, on("n") & (F.col("f.name") == F.col("n.name")), "left").join(nameless, on("u"), "left")
    )

    def by_name(prefix: str) -> Column:
        same = others(prefix, "n") + others(prefix, "u")
        return F.when(~F.col("f.allowed"), 0).when(F.col("f.name").isNull(), others(prefix, "e")).otherwise(same)

    return (
        joined.groupBy("f.id")
        .agg(
            F.sum(F.col("f.any") * others("pairs", "e")).alias("pairs"),
            F.sum(F.col("f.any") * by_name("pruned")).alias("pruned"),
            F.sum(F.col("f.any") * by_name("apart")).alias("apart"),
            F.sum((F.col("f.any") - F.col("f.bad")) * by_name("apart")).alias("kept"),
        )
        .filter("pairs > 0")
    )


def at_names(counted: DataFrame) -> DataFrame:
    return counted.filter(F.col("name").isNotNull())


def same_name(pairs: DataFrame) -> DataFrame:
    """Drop pairs whose names differ; an unknown name differs from none."""
    return pairs.filter(F.coalesce(F.col("name1") == F.col("name2"), F.lit(True)))


def prune_by_zone(pairs: DataFrame, edges: DataFrame, in_zone: DataFrame) -> DataFrame:
    """Drop pairs whose second link is a roundabout of the zones, or whose first
    link lies outside them and is not a trunk road.  ``in_zone`` holds the ids
    of the edges that meet a zone; a link merged earlier is no edge and is spared."""
    roundabout = edges.filter(F.col("junction") == "roundabout").join(in_zone, "id", "left_semi")
    outside = edges.filter(F.col("highway") != "trunk").join(in_zone, "id", "left_anti")
    return pairs.join(
        roundabout.select(F.col("id").alias("id2")), "id2", "left_anti"
    ).join(outside.select(F.col("id").alias("id1")), "id1", "left_anti")


def junction_conflicts(links: DataFrame, in_zone: DataFrame, edges: DataFrame) -> DataFrame:
    """id: links with a partner in conflict at a junction that ends both of them.
    A link merged earlier is none of the ``edges`` and counts as one of the zones.

    Such a partner is one whose own start is no junction; the other three ways
    of meeting at a junction are dropped as pairs straight away.
    """
    deg = degrees(links, loops=True)
    src = deg.select(F.col("node").alias("source"), F.col("degree").alias("ds"))
    dst = deg.select(F.col("node").alias("target"), F.col("degree").alias("dt"))
    at = (
        links.filter(F.col("oneway").isin(*DIRECTED) & (F.col("source") != F.col("target")))
        .join(dst.filter(F.col("dt") > 2), "target")
        .join(src.filter(F.col("ds") <= 2), "source")
        .join(in_zone.withColumn("inside", F.lit(True)), "id", "left")
        .withColumn("inside", F.coalesce("inside", F.lit(False)))
        .join(edges.select("id", F.lit(True).alias("edge")), "id", "left")
        .withColumn("spared", F.col("edge").isNull())
        .select("id", "target", "name", "oneway", "highway", "junction", "inside", "spared", "ds")
    )
    at = materialise(at, "junction")
    partner = ~(F.col("inside") & F.coalesce(F.col("junction") == "roundabout", F.lit(False)))
    kind = [F.count(F.when(partner & (F.col("oneway") == v), 1)).alias(f"k{i}") for i, v in enumerate(DIRECTED)]
    by_name = at.filter(F.col("name").isNotNull()).groupBy("target", "name").agg(*kind)
    nameless = at.filter(F.col("name").isNull()).groupBy("target").agg(
        *[c.alias(f"u{i}") for i, c in enumerate(kind)]
    )
    every = at.groupBy("target").agg(*[c.alias(f"a{i}") for i, c in enumerate(kind)])
    first = at.filter((F.col("ds") == 2) & (F.col("inside") | F.col("spared") | (F.col("highway") == "trunk")))
    rows = (
        first.join(by_name, ["target", "name"], "left")
        .join(nameless, "target", "left")
        .join(every, "target", "left")
    )

    def others(prefix: str) -> Column:
        total = F.lit(0)
        for i, v in enumerate(DIRECTED):
            total = total + F.when(F.col("oneway") == v, 0).otherwise(F.coalesce(f"{prefix}{i}", F.lit(0)))
        return total

    found = F.when(F.col("name").isNull(), others("a")).otherwise(others("k") + others("u"))
    return rows.filter(found > 0).select("id").distinct()


def carriageway_joins(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """id1: first links whose shared start has exactly three links of one name
    and one class in the full edge table (a dual carriageway joining)."""
    at = ends(edges, "id", "name", "highway").dropDuplicates(["node", "id"])
    whole = at.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("name").alias("names"),
        F.count_distinct("highway").alias("classes"),
    )
    three = whole.filter((F.col("n") == 3) & (F.col("names") == 1) & (F.col("classes") == 1))
    return (
        pairs.filter(F.col("node") == F.col("source1"))
        .join(three.select("node"), "node", "left_semi")
        .select("id1")
        .distinct()
    )


def surviving_pairs(links: DataFrame, in_zone: DataFrame, edges: DataFrame) -> DataFrame:
    """Conflict pairs left after every rule.

    Junction pairs are judged once: dropping them leaves none for another turn,
    and the rules on the remaining pairs look at nothing that changes.
    """
    pairs = materialise(prune_by_zone(same_name(conflict_pairs(links)), edges, in_zone), "pairs")
    tangled = junction_conflicts(links, in_zone, edges).withColumnRenamed("id", "id1")
    partner = pairs.join(tangled.withColumnRenamed("id1", "id2"), "id2", "left_semi").select("id1")
    gone = tangled.unionByName(partner).distinct()
    left = pairs.join(gone, "id1", "left_anti")
    return left.join(carriageway_joins(left, edges), "id1", "left_anti")


def fix_nodes(pairs: DataFrame) -> DataFrame:
    """node, id1, id2 (id1 < id2): the shared nodes of the surviving pairs."""
    return pairs.select(
        "node", F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2")
    ).distinct()


def counted_degrees(links: DataFrame, fixes: DataFrame) -> DataFrame:
    """Degree without loops, with the nodes set aside for a oneway fix left out."""
    return degrees(links).join(fixes.select("node"), "node", "left_anti")


def avoid_nodes(links: DataFrame, counted: DataFrame) -> DataFrame:
    """node, id: at a degree-2 node, links without a oneway that meet one with it."""
    two = counted.filter(F.col("degree") == 2).select("node")
    at = ends(links, "id", "oneway").join(two, "node", "left_semi")
    valued = at.groupBy("node").agg(F.bool_or(F.col("oneway").isin(*DIRECTED)).alias("valued"))
    open_links = at.filter(F.col("oneway").isNull()).select("node", "id").distinct()
    return open_links.join(valued.filter("valued").select("node"), "node", "left_semi")


def mergeable_nodes(
    counted: DataFrame, near_zone: DataFrame, avoid: DataFrame
) -> DataFrame:
    """node: degree 2, near a zone, not to be avoided; fix nodes are not counted."""
    return (
        counted.filter(F.col("degree") == 2)
        .select("node")
        .join(near_zone.select(F.col("nodeid").alias("node")).distinct(), "node", "left_semi")
        .join(avoid.select("node").distinct(), "node", "left_anti")
    )


def align_oneway(links: DataFrame, fixes: DataFrame) -> DataFrame:
    """At each fix node the shorter of its two links takes over the longer one's
    oneway; where both have a value and differ, its two costs change places."""
    at = ends(links, "id", "oneway", "length", loops=False).join(
        fixes.select("node").distinct(), "node", "left_semi"
    )
    row = F.struct("length", "id", "oneway")
    # Longest first, least id on a tie; shortest first, least id on a tie.
    long_row = F.max(F.struct("length", (-F.col("id")).alias("k"), "id", "oneway"))
    pair = at.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("oneway").alias("kinds"),
        F.min(row).alias("short"),
        long_row.alias("long"),
    )
    change = pair.filter((F.col("n") == 2) & (F.col("short.id") != F.col("long.id"))).select(
        F.col("short.id").alias("id"),
        F.col("long.oneway").alias("new_oneway"),
        (F.col("kinds") == 2).alias("swap"),
        F.lit(True).alias("hit"),
    )
    joined = links.join(change, "id", "left")
    swap = F.coalesce(F.col("swap"), F.lit(False))
    changed = {"oneway": F.when(F.col("hit"), F.col("new_oneway")).otherwise(F.col("oneway"))}
    pairs = [("cost", "reverse_cost")]
    if "cost_safe" in links.columns:
        pairs.append(("cost_safe", "reverse_cost_safe"))
    for a, b in pairs:
        changed[a] = F.when(swap, F.col(b)).otherwise(F.col(a))
        changed[b] = F.when(swap, F.col(a)).otherwise(F.col(b))
    return joined.withColumns(changed).select(*links.columns)


def ready_fixes(links: DataFrame, fixes: DataFrame) -> DataFrame:
    """Fix nodes no link ties to a lesser fix node: these can be settled together."""
    marked = fixes.select("node").distinct()
    at = ends(links, "id", loops=False).join(marked, "node", "left_semi")
    lead = at.groupBy("id").agg(F.min("node").alias("lead"))
    waits = at.join(lead, "id").filter(F.col("lead") < F.col("node")).select("node").distinct()
    return marked.join(waits, "node", "left_anti")
