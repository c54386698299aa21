"""Pairwise matches to groups: deterministic Borůvka hooking.

Each round every component selects its smallest outgoing edge, the resulting trees collapse by pointer
doubling, and the edges are relabelled and deduplicated; the rounds end when no edge is left. A round at least halves
the components that still have edges, so there are at most log2(n) rounds of log2(depth) doublings.

No step needs more than one row of a component at a time: a hub or a component that holds a third of all edges is
reduced by map-side partial aggregation (minimum edge, deduplication), and its joins are with a table that has one
row for a component, which adaptive execution may split on the edges' side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filanda.runtime import cut, drop

#: Rounds that no input can exceed: components at least halve in each.
MAX_ROUNDS = 64


def normal_id(col: Column) -> Column:
    """Lower case, without outer white space; null for an id that is then empty."""
    return F.nullif(F.lower(F.regexp_replace(col, r"(?U)^\s+|\s+$", "")), F.lit(""))


def clean_edges(links: DataFrame, min_weight: float | None) -> DataFrame:
    """Undirected edges ``lo, hi, cost`` with ``lo < hi``; one row a pair, its cost the negated largest weight.

    Null ends, ids that are blank, loops, null or NaN weights and weights below ``min_weight`` are left out.
    """
    e = links.select(normal_id(F.col("source")).alias("s"), normal_id(F.col("target")).alias("t"), F.col("weight").cast("double").alias("w"))
    e = e.where("s <> t and w is not null and not isnan(w)")
    if min_weight is not None:
        e = e.where(F.col("w") >= min_weight)
    return e.groupBy(F.least("s", "t").alias("lo"), F.greatest("s", "t").alias("hi")).agg((-F.max("w")).alias("cost"))


def _hook(edges: DataFrame) -> DataFrame:
    """``c, p``: the neighbour over each component's smallest edge by (cost, lo, hi).

    The order is total over edges, so the only cycles are two components that chose one edge; the smaller of them becomes a root.
    An edge is chosen at most twice, so the grouping by chosen edge that finds this has no hot key, as a join on the neighbour
    would in a star.
    """
    ends = edges.select(F.explode(F.array("lo", "hi")).alias("c"), F.struct("cost", "lo", "hi").alias("e"))
    chosen = ends.groupBy("c").agg(F.min("e").alias("e")).select("c", "e.lo", "e.hi")
    by_edge = chosen.groupBy("lo", "hi").agg(F.min("c").alias("c"), F.count("*").alias("n"))
    pair = lambda c, p: F.struct(F.col(c).alias("c"), F.col(p).alias("p"))
    other = F.struct("c", F.when(F.col("c") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("p"))
    return by_edge.select(F.explode(F.when(F.col("n") == 2, F.array(pair("lo", "lo"), pair("hi", "lo"))).otherwise(F.array(other)))
        .alias("x")).select("x.*")


def _collapse(parents: DataFrame) -> DataFrame:
    """``c, root`` by pointer doubling; the root is the smallest id of its tree."""
    p = cut(parents)
    while True:
        up = p.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        nxt = cut(p.join(up, "p").select("c", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")))
        moving = nxt.where("moved").limit(1).count()
        drop(p)
        p = nxt
        if not moving:
            break
    names = p.groupBy("p").agg(F.min("c").alias("root"))
    out = cut(p.join(names, "p").select("c", "root"))
    drop(p)
    return out


def connected_groups(links: DataFrame, min_weight: float | None = None) -> DataFrame:
    """``node_id, group_id`` for every node with an edge to another; ``group_id`` is the group's smallest id in binary order.

    ``links`` has ``source, target`` (strings) and ``weight``; further columns are ignored. Ids compare after
    ``normal_id``. An empty table, or one without usable edges, gives an empty result. Repeated rows, either
    direction and ties in weight change nothing: the result does not depend on partitioning.
    """
    edges = cut(clean_edges(links, min_weight))
    labels: DataFrame | None = None
    first: DataFrame | None = None
    for _ in range(MAX_ROUNDS):
        if not edges.limit(1).count():
            break
        roots = _collapse(_hook(edges))
        if labels is None:
            labels, first = roots.select(F.col("c").alias("node_id"), F.col("root").alias("group_id")), roots
        else:
            new = roots.select(F.col("c").alias("group_id"), "root")
            before, labels = labels, cut(labels.join(new, "group_id", "left").select("node_id", F.coalesce("root", "group_id").alias("group_id")))
            drop(before, first)
            first = None
        a = roots.select(F.col("c").alias("lo"), F.col("root").alias("a"))
        b = roots.select(F.col("c").alias("hi"), F.col("root").alias("b"))
        left = edges.join(a, "lo").join(b, "hi").where("a <> b")
        before, edges = edges, cut(left.groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(F.min("cost").alias("cost")))
        drop(before, roots if roots is not first else None)
    else:
        raise RuntimeError("components did not settle")
    return labels if labels is not None else edges.select(F.col("lo").alias("node_id"), F.col("hi").alias("group_id"))
