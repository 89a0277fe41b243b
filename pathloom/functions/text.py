"""Text and attribute expressions: node lists, oneway costs, names, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper limits in metres and labels of the desire-line bands.
LINE_BANDS = (
    (5000, "0-5 km"),
    (10000, "5-10 km"),
    (15000, "10-15 km"),
    (20000, "15-20 km"),
    (25000, "20-25 km"),
)
LINE_BAND_LAST = "25+ km"

# Upper limits in kilometres and labels of the summary bins.
COST_BINS = ((1, "0-1"), (2, "1-2"), (5, "2-5"), (9, "5-9"), (14, "9-14"), (20, "14-20"))
COST_BIN_LAST = ">20"

# Fixed value: the mark of a direction that may not be travelled.
BLOCKED = -1.0


def node_list(nodes: Column) -> Column:
    return F.split(nodes, ",")


def first_node(nodes: Column) -> Column:
    return F.element_at(node_list(nodes), 1).cast("bigint")


def last_node(nodes: Column) -> Column:
    return F.element_at(node_list(nodes), -1).cast("bigint")


def forward_cost(oneway: Column, length: Column) -> Column:
    return F.when(oneway == "-1", F.lit(BLOCKED)).otherwise(length)


def backward_cost(oneway: Column, length: Column) -> Column:
    return F.when(oneway == "yes", F.lit(BLOCKED)).otherwise(length)


def distance_band(cost: Column) -> Column:
    """Label of the half-open 5 km band that holds ``cost`` (metres)."""
    limit, label = LINE_BANDS[0]
    band = F.when(cost < limit, label)
    for limit, label in LINE_BANDS[1:]:
        band = band.when(cost < limit, label)
    return band.otherwise(LINE_BAND_LAST)


def cost_bin(cost_m: Column) -> Column:
    """Label of the bin, upper end included, that holds ``cost_m``; last is open."""
    km = cost_m / 1000
    limit, label = COST_BINS[0]
    out = F.when(km <= limit, label)
    for limit, label in COST_BINS[1:]:
        out = out.when(km <= limit, label)
    return out.when(km.isNotNull(), COST_BIN_LAST)


def drop_first(text: Column, part: str) -> Column:
    """Remove the first occurrence of ``part`` only."""
    return swap_first(text, part, "")


def swap_first(text: Column, part: str, new: str) -> Column:
    at = F.instr(text, part)
    return F.when(
        at > 0,
        F.concat(
            F.substring(text, F.lit(1), at - 1),
            F.lit(new),
            F.substring(text, at + len(part), F.length(text)),
        ),
    ).otherwise(text)


def clean_names(name: Column) -> Column:
    """The road names held by one text: split on commas and tidied."""
    return F.transform(
        F.split(name, ","),
        lambda s: F.replace(
            F.replace(swap_first(drop_first(s, "{"), " / ", "_"), F.lit('"'), F.lit("")),
            F.lit("}"),
            F.lit(""),
        ),
    )


def clean_flags(flag: Column) -> Column:
    """The foot values held by one text: split on commas, one brace pair off."""
    return F.transform(F.split(flag, ","), lambda s: drop_first(drop_first(s, "{"), "}"))


def joined_set(values: Column) -> Column:
    """Aggregate: distinct non-NULL values, sorted, joined by commas ('' if none)."""
    return F.concat_ws(",", F.array_sort(F.collect_set(values)))
