"""Bounded shortest-path reach from many origins.

The arcs are split once into spatial blocks of bounded size; a node whose arcs
lie in several blocks is a seam between them.  The search runs on the seams: in a
round, each block that holds a seam node another block has improved is relaxed to
its fixed point for a chunk of origins, from the seam costs it knows, and hands on
only the seam costs that got better.  Nodes inside a block never leave it during
the search.  At the end every block that was reached is relaxed once more and gives
the rows asked for, with the step that reaches each node.

The state of a round is one row per origin and seam node; a round reads the state
of the round before and no other.  The number of rounds is the number of blocks a
path crosses, not the number of links it has.

Costs are always summed link by link from the origin.  Shortcuts over a block, summed
on their own, would round differently and break ties differently.

Blocks only decide where work is done: any split gives the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.operators.ranks import numbered
from pathloom.session import materialise, materialise_with, scratch_path, ship_functions

ship_functions(__name__)

# Nodes of one block, and origins relaxed together in one block.
BLOCK_NODES = 4096
CHUNK_ORIGINS = 16
# More steps than any path has.
FAR = 1 << 30

_SEAMS = "home bigint, chunk bigint, origin bigint, node bigint, agg_cost double, depth int, limit double"
_STEP = ("agg_cost", "depth", "pred", "edge", "cost")
_STEPS = "home bigint, chunk bigint, origin bigint, node bigint, agg_cost double, depth int, pred bigint, edge bigint, cost double, seam boolean"


def undirected_arcs(links: DataFrame) -> DataFrame:
    """src, dst, edge, w: each link both ways at its least non-negative cost."""
    ok = [F.when(F.col(c) >= 0, F.col(c)) for c in ("cost", "reverse_cost")]
    base = (
        links.filter(F.col("source") != F.col("target"))
        .select("id", "source", "target", F.least(*ok).alias("w"))
        .filter(F.col("w").isNotNull())
    )
    return _thin(base.select(F.explode(_both_ways("w", "w")).alias("a")).select("a.*"))


def directed_arcs(links: DataFrame) -> DataFrame:
    """src, dst, edge, w: each direction whose cost is not negative."""
    base = links.filter(F.col("source") != F.col("target"))
    arcs = base.select(F.explode(_both_ways("cost", "reverse_cost")).alias("a")).select("a.*")
    return _thin(arcs.filter(F.col("w") >= 0))


def _both_ways(out: str, back: str) -> Column:
    def arc(a: str, b: str, w: str) -> Column:
        return F.struct(
            F.col(a).alias("src"), F.col(b).alias("dst"), F.col("id").alias("edge"), F.col(w).alias("w")
        )

    return F.array(arc("source", "target", out), arc("target", "source", back))


def _thin(arcs: DataFrame) -> DataFrame:
    """Keep the cheapest of parallel arcs (then the least edge)."""
    best = F.min(F.struct("w", "edge"))
    return arcs.groupBy("src", "dst").agg(best.alias("b")).select("src", "dst", "b.edge", "b.w")


def node_blocks(places: DataFrame, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """node, block: runs of ``block_nodes`` nodes along a Z-order curve, so that every
    block is a compact patch, also where nodes are dense or one of them lies far off.
    Nodes without a place come last."""
    x, y = F.col("x"), F.col("y")
    got = places.agg(
        F.min(x).alias("x0"), F.min(y).alias("y0"), F.greatest(F.max(x) - F.min(x), F.max(y) - F.min(y)).alias("span")
    ).first()
    unit = max(got["span"] or 0.0, 1.0) / 2**30
    code = _spread(F.floor((x - (got["x0"] or 0.0)) / unit)) + 2 * _spread(F.floor((y - (got["y0"] or 0.0)) / unit))
    spots = places.select(F.col("nodeid").alias("node"), F.coalesce(code, F.lit(2**62)).alias("code"))
    rows, _ = numbered(spots, ["code", "node"], name="k")
    return rows.select("node", F.expr(f"(k - 1) div {block_nodes}").alias("block"))


def _spread(v: Column) -> Column:
    """The low 31 bits of a number, with a gap of one bit between any two."""
    v = v.cast("bigint")
    # The usual masks for interleaving bits.
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = F.shiftleft(v, shift).bitwiseOR(v).bitwiseAND(F.lit(mask))
    return v


def homed_arcs(arcs: DataFrame, places: DataFrame, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """Arcs with their block: that of the end with fewer arcs, so that the arcs
    of a hub are spread over the blocks of its neighbours.  ``seam`` marks arcs
    whose far end lies in several blocks."""
    degree = arcs.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("deg"))
    spot = node_blocks(places, block_nodes).join(degree, "node", "left")
    rank = F.struct(F.coalesce("deg", F.lit(0)).alias("deg"), "node").alias("rank")
    spot = spot.select("node", rank, "block")
    src = spot.select(F.col("node").alias("src"), F.col("rank").alias("r1"), F.col("block").alias("b1"))
    dst = spot.select(F.col("node").alias("dst"), F.col("rank").alias("r2"), F.col("block").alias("b2"))
    home = F.when(F.col("r1") <= F.col("r2"), F.col("b1")).otherwise(F.col("b2"))
    placed = (
        arcs.join(src, "src").join(dst, "dst").select("src", "dst", "edge", "w", home.alias("home"))
    )
    placed = materialise(placed, "arcs")
    seams = (
        node_homes(placed)
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select(F.col("node").alias("dst"), F.lit(True).alias("seam"))
    )
    return placed.join(seams, "dst", "left").select(
        "home", "src", "dst", "edge", "w", F.coalesce("seam", F.lit(False)).alias("seam")
    )


def node_homes(homed: DataFrame) -> DataFrame:
    both = F.explode(F.array("src", "dst")).alias("node")
    return homed.select(both, "home").distinct()


def _chunks(seeds: DataFrame, homes: DataFrame) -> DataFrame:
    """Origins of one neighbourhood share a chunk, at most about CHUNK_ORIGINS to one."""
    near = homes.groupBy("node").agg(F.min("home").alias("nb"))
    placed = seeds.join(near, "node", "left")
    full = placed.groupBy("nb").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ORIGINS).alias("parts"))
    part = F.pmod(F.xxhash64("origin"), F.coalesce("parts", F.lit(1)))
    return placed.join(full, "nb", "left").withColumn("chunk", F.xxhash64("nb", part))


_ARCS = {"names": "i8", "src": "i4", "dst": "i4", "edge": "i8", "w": "f8", "seam": "?", "goal": "?"}
_PACKED = "home bigint, " + ", ".join(f"{c} binary" for c in _ARCS)


def _pack(key: tuple, arcs: pd.DataFrame) -> pd.DataFrame:
    """The arcs of a block as one row of arrays: its nodes, and the arcs by head, tail and
    edge with their ends as positions among the nodes."""
    names, index = np.unique(np.concatenate([arcs["src"].to_numpy(), arcs["dst"].to_numpy()]), return_inverse=True)
    src, dst = index[: len(arcs)], index[len(arcs) :]
    order = np.lexsort([arcs["edge"].to_numpy(), src, dst])
    seam, goal = (np.zeros(len(names), dtype=bool) for _ in range(2))
    seam[dst], goal[dst] = arcs["seam"].to_numpy(), arcs["goal"].to_numpy()
    of = {"names": names, "src": src[order], "dst": dst[order], "seam": seam, "goal": goal}
    of |= {c: arcs[c].to_numpy()[order] for c in ("edge", "w")}
    return pd.DataFrame({"home": [key[0]], **{c: [of[c].astype(t).tobytes()] for c, t in _ARCS.items()}})


def packed(homed: DataFrame) -> DataFrame:
    """A row per block; rounds send a block to a chunk of origins as one value."""
    if "goal" not in homed.columns:
        homed = homed.withColumn("goal", F.lit(True))
    return homed.groupBy("home").applyInPandas(_pack, schema=_PACKED)


class Block:
    """The arcs of one block, by head, and the nodes they join."""

    def __init__(self, rows: pd.DataFrame):
        row = rows.iloc[0]
        for c, t in _ARCS.items():
            setattr(self, c, np.frombuffer(row[c], t))


class Relaxed:
    """Least (cost, depth) per origin and node of a block, from its known rows."""

    def __init__(self, block: Block, known: pd.DataFrame):
        self.block = block
        names, src, dst, w = block.names, block.src, block.dst, block.w
        self.origins, row = np.unique(known["origin"].to_numpy(), return_inverse=True)
        col = np.searchsorted(names, known["node"].to_numpy())
        # nodes by origins, so that a pass reads and writes whole rows
        cost = np.full((len(names), len(self.origins)), np.inf)
        depth = np.full(cost.shape, FAR, dtype=np.int32)
        limit = np.full(len(self.origins), np.inf)
        cost[col, row], depth[col, row] = known["agg_cost"].to_numpy(), known["depth"].to_numpy()
        limit[row] = known["limit"].to_numpy()
        self.first_cost, self.first_depth = cost.copy(), depth.copy()

        # Only arcs that leave a node improved in the last pass can improve another.
        hot = np.zeros(len(names), dtype=bool)
        hot[col] = True
        while True:
            use = np.flatnonzero(hot[src])
            if not len(use):
                break
            tail, head = src[use], dst[use]
            offer = cost[tail] + w[use][:, None]
            offer[offer > limit] = np.inf
            hops = depth[tail] + 1
            starts = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
            heads = head[starts]
            best, least = offer[starts], hops[starts]
            # a node with several such arcs takes them one after the other
            size = np.diff(np.r_[starts, len(head)])
            for k in range(1, int(size.max())):
                at = np.flatnonzero(size > k)
                o, h = offer[starts[at] + k], hops[starts[at] + k]
                wins = (o < best[at]) | ((o == best[at]) & (h < least[at]))
                best[at], least[at] = np.where(wins, o, best[at]), np.where(wins, h, least[at])
            had_cost, had_depth = cost[heads], depth[heads]
            better = (best < had_cost) | ((best == had_cost) & (least < had_depth) & np.isfinite(best))
            cost[heads] = np.where(better, best, had_cost)
            depth[heads] = np.where(better, least, had_depth)
            hot[:] = False
            hot[heads[better.any(axis=1)]] = True
        self.cost, self.depth, self.limit = cost, depth, limit

    def better_seams(self) -> pd.DataFrame:
        """Seam rows that got better than they were known."""
        better = (self.cost < self.first_cost) | ((self.cost == self.first_cost) & (self.depth < self.first_depth))
        c, r = np.nonzero(better & self.block.seam[:, None])
        return pd.DataFrame(
            {
                "origin": self.origins[r],
                "node": self.block.names[c],
                "agg_cost": self.cost[c, r],
                "depth": self.depth[c, r],
                "limit": self.limit[r],
            }
        )

    def steps(self) -> np.ndarray:
        """For each node and origin, the arc of the block that gives its cost and depth
        (least predecessor, then least edge); -1 where none does."""
        b = self.block
        out = np.full(self.cost.shape, -1)
        fits = (self.cost[b.src] + b.w[:, None] == self.cost[b.dst]) & (self.depth[b.src] + 1 == self.depth[b.dst])
        fits &= np.isfinite(self.cost[b.dst])
        # arcs stand by head, then predecessor, then edge: the first that fits is written last
        arc, origin = np.nonzero(fits)
        out[b.dst[arc[::-1]], origin[::-1]] = arc[::-1]
        return out

    def rows(self, r: np.ndarray, c: np.ndarray, arc: np.ndarray) -> dict:
        """Columns of the steps over some arcs, a root where the arc is -1."""
        b, root = self.block, arc < 0
        return {
            "origin": self.origins[r],
            "node": b.names[c],
            "agg_cost": self.cost[c, r],
            "depth": self.depth[c, r],
            "pred": b.names[np.where(root, c, b.src[arc])],
            "edge": np.where(root, -1, b.edge[arc]),
            "cost": np.where(root, 0.0, b.w[arc]),
        }


def _keyed(key: tuple, out: pd.DataFrame) -> pd.DataFrame:
    out.insert(0, "home", key[0])
    out.insert(1, "chunk", key[1])
    return out


def _relax(key: tuple, known: pd.DataFrame, arcs: pd.DataFrame) -> pd.DataFrame:
    return _keyed(key, Relaxed(Block(arcs), known).better_seams())


def _expand(key: tuple, known: pd.DataFrame, arcs: pd.DataFrame) -> pd.DataFrame:
    """Every row asked for of a block whose seam costs are final; roots are left out."""
    got = Relaxed(Block(arcs), known)
    arc = got.steps()
    c, r = np.nonzero((arc >= 0) & got.block.goal[:, None])
    return _keyed(key, pd.DataFrame({**got.rows(r, c, arc[c, r]), "seam": got.block.seam[c]}))


@dataclass(frozen=True)
class Search:
    """A finished search: arcs by block, the blocks of each node, packed blocks, the
    seeds, and the final cost of every seam node that was reached."""

    homed: DataFrame
    homes: DataFrame
    blocks: DataFrame
    seeds: DataFrame
    seams: DataFrame

    def known(self) -> DataFrame:
        """Final seam rows and seeds under every block that holds their node."""
        return self.seams.drop("home", "moved").join(self.homes, "node")


def search(
    seeds: DataFrame,
    arcs: DataFrame,
    places: DataFrame,
    radius: float | None = None,
    block_nodes: int = BLOCK_NODES,
) -> Search:
    """The search from all seeds within the radius (inclusive).

    ``seeds`` holds (origin, node) and, if it differs by origin, ``limit``; the
    radius is the limit otherwise.  ``places`` holds (nodeid, x, y).
    """
    spark = seeds.sparkSession
    homed = materialise(homed_arcs(arcs, places, block_nodes), "homed")
    homes = materialise(node_homes(homed), "homes")
    packs = materialise(packed(homed), "blocks")
    if "limit" not in seeds.columns:
        far = float("inf") if radius is None else float(radius)
        seeds = seeds.withColumn("limit", F.lit(far))
    state = _chunks(seeds.select("origin", "node", "limit").distinct(), homes).select(
        "origin",
        "node",
        "chunk",
        "limit",
        F.lit(0.0).alias("agg_cost"),
        F.lit(0).alias("depth"),
        F.lit(None).cast("bigint").alias("home"),
        F.lit(True).alias("moved"),
    )
    base = scratch_path(spark, "reach")
    state = begin = materialise(state, path=f"{base}/0")
    turn = 0
    while True:
        turn += 1
        # Blocks (for a chunk of origins) that another block has sent an offer to.
        # Written first: its size is then known when the plan is made, so the state
        # is filtered in place if the list is small and not shuffled for it.
        told = state.filter("moved").withColumnRenamed("home", "via").join(homes, "node")
        active = told.filter(~F.col("home").eqNullSafe(F.col("via"))).select("home", "chunk").distinct()
        active, todo = materialise_with(active, "active")
        if not todo["n"]:
            break
        known = state.drop("home", "moved").join(homes, "node").join(active, ["home", "chunk"], "left_semi")
        blocks = _blocks(active, packs)
        better = known.groupBy("home", "chunk").cogroup(blocks.groupBy("block", "to_chunk")).applyInPandas(_relax, schema=_SEAMS)
        every = state.withColumn("moved", F.lit(False)).unionByName(better.withColumn("moved", F.lit(True)))
        best = F.min(F.struct("agg_cost", "depth", "home", "moved")).alias("b")
        merged = every.groupBy("origin", "node", "chunk", "limit").agg(best).select("origin", "node", "chunk", "limit", "b.*")
        state, seen = materialise_with(merged, path=f"{base}/{turn}", moving=F.count(F.when(F.col("moved"), 1)))
        if not seen["moving"]:
            break
    return Search(homed, homes, packs, begin, state)


def _blocks(wanted: DataFrame, packs: DataFrame) -> DataFrame:
    """The packed blocks, once for every chunk of origins that needs them."""
    rows = wanted.select("home", F.col("chunk").alias("to_chunk")).join(packs, "home")
    return rows.withColumnRenamed("home", "block")


def reach(found: Search, at: DataFrame | None = None) -> DataFrame:
    """origin, node, agg_cost, depth and the step that reaches the node: pred, edge, cost.

    ``at`` (node) restricts the answer to some nodes, such as those of centroids: no
    row of another node leaves its block.  Of the steps that give the least (cost,
    depth), the one with the least predecessor and then the least edge is named.  An
    origin is its own predecessor over edge -1.
    """
    steps = materialise(expanded(found, at), "steps").select("origin", "node", *_STEP, "seam")
    # a node inside a block has its step there; that of a seam node may be in any of its blocks
    shared = steps.filter("seam").groupBy("origin", "node").agg(F.min(F.struct(*_STEP)).alias("b"))
    seeds = found.seeds if at is None else found.seeds.join(at, "node", "left_semi")
    roots = seeds.select(
        "origin",
        "node",
        "agg_cost",
        "depth",
        F.col("node").alias("pred"),
        F.lit(-1).cast("bigint").alias("edge"),
        F.lit(0.0).alias("cost"),
    ).distinct()
    inner = steps.filter(~F.col("seam")).drop("seam")
    return inner.unionByName(shared.select("origin", "node", "b.*")).unionByName(roots)


def expanded(found: Search, at: DataFrame | None = None, seams: bool = False) -> DataFrame:
    """The steps of each block into the nodes of ``at`` (all nodes without it) and, if
    asked, into its seam nodes.  A seam node may have a row in each of its blocks."""
    known, packs = found.known(), found.blocks
    if at is not None:
        marks = at.select(F.col("node").alias("dst"), F.lit(True).alias("goal")).distinct()
        goal = F.coalesce("goal", F.col("seam") if seams else F.lit(False))
        packs = packed(found.homed.join(marks, "dst", "left").withColumn("goal", goal))
    blocks = _blocks(known.select("home", "chunk").distinct(), packs)
    return known.groupBy("home", "chunk").cogroup(blocks.groupBy("block", "to_chunk")).applyInPandas(_expand, schema=_STEPS)


def reach_costs(
    seeds: DataFrame,
    arcs: DataFrame,
    places: DataFrame,
    radius: float | None = None,
    block_nodes: int = BLOCK_NODES,
    at: DataFrame | None = None,
) -> DataFrame:
    """:func:`search` and :func:`reach` in one."""
    return reach(search(seeds, arcs, places, radius, block_nodes), at)


# ---- weak components ------------------------------------------------------------------


def _local_parts(arcs: pd.DataFrame) -> pd.DataFrame:
    """Each node of a block with the least node that it hangs together with there."""
    names, index = np.unique(np.concatenate([arcs["src"].to_numpy(), arcs["dst"].to_numpy()]), return_inverse=True)
    a, b = index[: len(arcs)], index[len(arcs) :]
    least = np.arange(len(names))
    while True:
        new = least.copy()
        np.minimum.at(new, a, least[b])
        np.minimum.at(new, b, least[a])
        new = new[new]
        if (new == least).all():
            return pd.DataFrame({"node": names, "part": names[least]})
        least = new


def weak_components(homed: DataFrame) -> DataFrame:
    """node, component: the least node that hangs together with a node, directions aside.

    Parts are found inside each block; only parts that share a seam node are joined
    across blocks, by handing on the least part and jumping to its own.
    """
    parts = homed.select("home", "src", "dst").groupBy("home").applyInPandas(lambda k, a: _local_parts(a), "node bigint, part bigint")
    parts = materialise(parts, "parts")
    shared = parts.groupBy("node").agg(F.min("part").alias("a"), F.array_distinct(F.collect_list("part")).alias("all"))
    pairs = shared.select("a", F.explode("all").alias("b")).filter("a <> b").distinct()
    both = materialise(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "pairs")
    label = materialise(both.select(F.col("a").alias("part"), F.col("a").alias("root")).distinct(), "label")
    while True:
        offers = both.join(label, F.col("b") == F.col("part")).select(F.col("a").alias("part"), "root")
        least = label.unionByName(offers).groupBy("part").agg(F.min("root").alias("root"))
        least = materialise(least, "least")
        up = least.select(F.col("part").alias("root"), F.col("root").alias("up"))
        jumped = least.join(up, "root").join(label.withColumnRenamed("root", "had"), "part")
        label, seen = materialise_with(jumped.select("part", F.col("up").alias("root"), "had"), "label", moved=F.count(F.when(F.col("root") != F.col("had"), 1)))
        label = label.drop("had")
        if not seen["moved"]:
            break
    named = parts.join(label, "part", "left").select("node", F.coalesce("root", "part").alias("component"))
    return named.groupBy("node").agg(F.min("component").alias("component"))


# ---- walking back ---------------------------------------------------------------------

_WALK = "route_id bigint, origin bigint, chunk bigint, node bigint, agg_cost double, depth int, pred bigint, edge bigint, cost double, open boolean"


def _walk(key: tuple, known: pd.DataFrame, arcs: pd.DataFrame) -> pd.DataFrame:
    """Path rows inside a block, from the node each goal stands on back to the first
    seam node (an ``open`` row, to be taken up by the block of its step) or the origin."""
    goals = known[known["route_id"].notna()]
    rows = known[known["route_id"].isna() & known["origin"].isin(goals["origin"])]
    got = Relaxed(Block(arcs), rows)
    b, arc = got.block, got.steps()
    r = np.searchsorted(got.origins, goals["origin"].to_numpy())
    c = np.searchsorted(b.names, goals["node"].to_numpy())
    route = goals["route_id"].to_numpy().astype(np.int64)
    out = []
    here = arc[c, r]  # the least step of the node is one of this block
    while len(r):
        part = pd.DataFrame({"route_id": route, **got.rows(r, c, here)})
        part["open"] = False
        out.append(part)
        on = here >= 0
        r, route, c = r[on], route[on], b.src[here[on]]
        here = arc[c, r]
        stop = b.seam[c] & (got.depth[c, r] > 0)
        if stop.any():
            part = pd.DataFrame({"route_id": route[stop], **got.rows(r[stop], c[stop], here[stop])})
            part["open"] = True
            out.append(part)
        r, route, c, here = r[~stop], route[~stop], c[~stop], here[~stop]
        here = np.where(got.depth[c, r] == 0, -1, here)
    done = pd.concat(out, ignore_index=True)
    done.insert(2, "chunk", key[1])
    return done


def walk_back(found: Search, goals: DataFrame) -> DataFrame:
    """route_id, node, depth, pred, edge, cost, agg_cost: the rows of the paths to goals.

    ``goals`` holds (route_id, origin, node); one that was not reached has no rows.  A
    goal goes back through the block of its step and is handed on at each seam node, so
    that only rows of paths leave a block.
    """
    columns = ("route_id", "node", "depth", "pred", "edge", "cost", "agg_cost")
    steps = materialise(expanded(found, goals.select("node"), seams=True), "steps")
    best = F.min(F.struct(*_STEP, "home", "chunk")).alias("b")
    steps = materialise(steps.groupBy("origin", "node").agg(best).select("origin", "node", "b.home", "b.chunk"), "best_steps")
    spark, base = goals.sparkSession, scratch_path(goals.sparkSession, "walk")
    seeds = found.seeds.select("origin", "node").distinct()
    start = goals.join(seeds, ["origin", "node"], "left_semi").select(
        "route_id", "node", F.lit(0).alias("depth"), F.col("node").alias("pred"), F.lit(-1).cast("bigint").alias("edge"),
        F.lit(0.0).alias("cost"), F.lit(0.0).alias("agg_cost"), "origin", F.lit(None).cast("bigint").alias("chunk"), F.lit(False).alias("open"),
    )
    walked = [f"{base}/0"]
    materialise(start, path=walked[0])
    ahead = goals.join(seeds, ["origin", "node"], "left_anti")
    state = found.known().withColumn("route_id", F.lit(None).cast("bigint"))
    while True:
        at = ahead.select("route_id", "origin", "node").join(steps, ["origin", "node"])
        at, todo = materialise_with(at, "ahead")
        if not todo["n"]:
            break
        where = at.select("home", "chunk").distinct()
        asked = at.withColumns({"agg_cost": F.lit(None).cast("double"), "depth": F.lit(None).cast("int"), "limit": F.lit(None).cast("double")})
        known = state.join(where, ["home", "chunk"], "left_semi").unionByName(asked)
        blocks = _blocks(where, found.blocks)
        rows = known.groupBy("home", "chunk").cogroup(blocks.groupBy("block", "to_chunk")).applyInPandas(_walk, schema=_WALK)
        walked.append(f"{base}/{len(walked)}")
        rows = materialise(rows, path=walked[-1])
        ahead = rows.filter("open")
    return spark.read.schema(start.schema).parquet(*walked).filter(~F.col("open")).select(*columns)
