"""Texts into containers of fixed capacity: cost-balanced packing.

A sequence of ``n`` tokens made of texts of ``n1 .. nk`` tokens costs about ``linear * n + quadratic * (n1² + .. + nk²)``: the layers' work
on every token, and attention within each text. Texts are assigned in descending size to the open sequence of lowest cost that has room;
a new one opens only when none has. The number of sequences open at first is the least that the sizes allow, so the containers
end nearly full and about equally dear.

The pieces are spread by hash over shards of about ``shard_tokens`` tokens, each packed by itself; a shard leaves less than one container
unfilled beyond what its sizes force. The number of shards follows the total, never a task's memory.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LINEAR, QUADRATIC = 1.0, 1.0 / 4096


def pack(sizes: np.ndarray, capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> np.ndarray:
    """Container number of every size, from 0; sizes are at most the capacity, and given in descending order.

    Open containers wait in a heap by cost; those without room for the present size are set aside, and come back when smaller sizes do.
    """
    out = np.empty(len(sizes), dtype=np.int64)
    if not len(sizes):
        return out
    n_open = int(-(-int(sizes.sum()) // capacity))
    room = [capacity] * n_open
    heap = [(0.0, i) for i in range(n_open)]
    aside: list[tuple[int, float, int]] = []  # by room, the largest first
    for k, size in enumerate(sizes.tolist()):
        while aside and -aside[0][0] >= size:
            r, cost, i = heapq.heappop(aside)
            heapq.heappush(heap, (cost, i))
        while heap and room[heap[0][1]] < size:
            cost, i = heapq.heappop(heap)
            heapq.heappush(aside, (-room[i], cost, i))
        if heap:
            cost, i = heapq.heappop(heap)
        else:
            cost, i = 0.0, len(room)
            room.append(capacity)
        out[k] = i
        room[i] -= size
        heapq.heappush(heap, (cost + linear * size + quadratic * size * size, i))
    return out


def _cuts(sized: DataFrame, packs: DataFrame) -> DataFrame:
    """``pack_name, capacity, doc_id, all, copies, n_full``: each text once for each capacity, repeated rows counted, with the
    number of containers that it fills by itself.

    ``packs`` (``pack_name, capacity_tokens``) must fit a broadcast: at most 10,000 rows, which is checked.
    """
    list_of = F.collect_list(F.struct("pack_name", F.col("capacity_tokens").alias("capacity")))
    one = packs.where("capacity_tokens > 0 and pack_name is not null").groupBy("pack_name").agg(F.min("capacity_tokens")
        .alias("capacity_tokens")).agg(list_of.alias("packs"))
    one = one.withColumn("packs", F.when(F.size("packs") > 10_000, F.raise_error(F.lit("more than 10000 capacities"))).otherwise(F.col("packs")))
    texts = sized.where("n_tokens > 0").groupBy("doc_id", F.col("n_tokens").cast("long").alias("all")).agg(F.count("*").alias("copies"))
    each = texts.join(F.broadcast(one)).select("doc_id", "all", "copies", F.explode("packs").alias("p")).select("p.*", "doc_id", "all", "copies")
    return each.withColumn("n_full", F.expr("all div capacity"))


def pack_documents(sized: DataFrame, packs: DataFrame, shard_tokens: int = 20_000_000, linear: float = LINEAR,
    quadratic: float = QUADRATIC) -> DataFrame:
    """``pack_name, container, doc_id, piece_no, token_start, n_tokens``: the container of every piece of every text.

    ``sized`` has ``doc_id, n_tokens``; further columns are ignored. A text longer than a container is cut into full containers
    and a rest; no other is cut. Texts without tokens, null sizes and non-positive capacities are left out; repeated rows are
    packed as often as they come, each copy of a full piece in a container of its own. An empty table gives an empty result.
    ``container`` is unique within its ``pack_name``: the shard's number times 2**32 plus the number in the shard, for the pieces
    that fill a container by themselves counted downwards from -1. Ties in size are settled by ``doc_id`` and ``piece_no``, so the
    result does not depend on partitioning. Copies of one row spread over the shards, so a row may be repeated any number of
    times.
    """
    cuts = _cuts(sized.select("doc_id", "n_tokens"), packs)
    shards = F.broadcast(sized.agg(F.greatest(F.lit(1), F.ceil(F.coalesce(F.sum("n_tokens"), F.lit(0)) / shard_tokens)).cast("long")
        .alias("shards")))  # one row
    copies = F.explode(F.expr("sequence(1L, copies)")).alias("copy_no")
    rest = cuts.where("all % capacity > 0").select("pack_name", "capacity", "doc_id", "all", "n_full", copies).join(shards).select(
        "pack_name", "capacity", "doc_id", F.col("n_full").cast("int").alias("piece_no"), F.expr("n_full * capacity").alias("token_start"),
            F.expr("all % capacity").alias("n_tokens"),
        F.pmod(F.xxhash64("doc_id", "pack_name", "copy_no"), "shards").alias("shard"),
    )

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "piece_no"], ascending=[False, True, True], kind="stable", ignore_index=True)
        at = pack(pdf["n_tokens"].to_numpy(), int(pdf["capacity"].iloc[0]), linear, quadratic)
        return pdf.assign(container=pdf["shard"] * 2**32 + at)[["pack_name", "container", "doc_id", "piece_no", "token_start", "n_tokens"]]

    schema = "pack_name string, container long, doc_id long, piece_no int, token_start long, n_tokens long"
    packed = rest.groupBy("pack_name", "shard").applyInPandas(fill, schema)
    # a full piece is a container of its own: its row's place among its shard's full pieces, and its place in the row
    long = cuts.where("n_full > 0").join(shards).withColumn("shard", F.pmod(F.xxhash64("doc_id", "pack_name"), "shards"))
    before = Window.partitionBy("pack_name", "shard").orderBy("doc_id", "all").rowsBetween(Window.unboundedPreceding, -1)
    placed = long.withColumn("base", F.coalesce(F.sum(F.expr("n_full * copies")).over(before), F.lit(0)))
    own = placed.select("pack_name", "capacity", "doc_id", "n_full", "shard", "base",
        F.explode(F.expr("sequence(0L, n_full * copies - 1)")).alias("i"))
    number = F.expr(f"-1 - (shard * {2**32} + base + i)")
    own = own.select("pack_name", number.alias("container"), "doc_id", F.expr("cast(i % n_full as int)").alias("piece_no"),
        F.expr("(i % n_full) * capacity").alias("token_start"), F.col("capacity").alias("n_tokens"))
    return packed.unionByName(own)


def pack_audit(packed: DataFrame, sized: DataFrame, packs: DataFrame) -> DataFrame:
    """``pack_name, texts, over_capacity, split_needlessly, wrong_length, well_filled``: what a packing must keep, counted for each capacity.

    Texts placed; containers beyond their capacity; texts cut although they fit; texts whose pieces do not add up to their length;
    and whether more than 95 % of the space of all containers but one is used.
    """
    caps = packs.groupBy("pack_name").agg(F.min("capacity_tokens").alias("cap"))
    lengths = sized.groupBy("doc_id").agg(F.sum("n_tokens").alias("want"), F.max("n_tokens").alias("longest"))
    texts = packed.groupBy("pack_name", "doc_id").agg(F.sum("n_tokens").alias("got"), F.max("piece_no").alias("last")).join(lengths,
        "doc_id").join(F.broadcast(caps), "pack_name")
    per_text = texts.groupBy("pack_name").agg(F.count("*").alias("texts"),
        F.count_if(F.expr("last > 0 and longest <= cap")).alias("split_needlessly"), F.count_if(F.expr("got <> want")).alias("wrong_length"))
    used = packed.groupBy("pack_name", "container").agg(F.sum("n_tokens").alias("n")).join(F.broadcast(caps), "pack_name")
    per_box = used.groupBy("pack_name").agg(F.count_if(F.expr("n > cap")).alias("over_capacity"),
        (F.sum("n") > F.lit(0.95) * (F.sum("cap") - F.max("cap"))).alias("well_filled"))
    return per_text.join(per_box, "pack_name").select("pack_name", "texts", "over_capacity", "split_needlessly", "wrong_length", "well_filled")


def pack_report(packed: DataFrame, packs: DataFrame, linear: float = LINEAR, quadratic: float = QUADRATIC) -> DataFrame:
    """``pack_name, containers, tokens, used_share, mean_cost, max_cost``: how full the containers are, and how even their cost."""
    cost = F.sum(F.lit(linear) * F.col("n_tokens") + F.lit(quadratic) * F.col("n_tokens") * F.col("n_tokens"))
    per = packed.groupBy("pack_name", "container").agg(F.sum("n_tokens").alias("n"), cost.alias("cost"))
    done = per.groupBy("pack_name").agg(F.count("*").alias("containers"), F.sum("n").alias("tokens"), F.avg("cost").alias("mean_cost"),
        F.max("cost").alias("max_cost"))
    caps = packs.groupBy("pack_name").agg(F.min("capacity_tokens").alias("cap"))
    return done.join(F.broadcast(caps), "pack_name").select("pack_name", "containers", "tokens",
        (F.col("tokens") / (F.col("containers") * F.col("cap"))).alias("used_share"), "mean_cost", "max_cost")
