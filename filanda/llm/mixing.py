"""A mixture of sources to target weights: weighted fair queueing.

Every document of a source, in a keyed shuffled order, gets a virtual finish time: the source's tokens up to and including
it, over the source's weight. Served in the order of these times the sources keep their shares at every moment, so the mixture is the prefix of
that order up to the budget. A small source is repeated in further rounds, up to its cap, each round shuffled anew.

No source passes through one task: documents fall into buckets by their shuffle hash, the buckets' sums (one row each) give
the offsets, and within a bucket a window gives the rest. The cut at the budget works likewise over ranges of the finish time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filanda.runtime import cut

#: Documents of a bucket, about; a bucket is what one task sorts.
BUCKET = 200_000


def _running(df: DataFrame, group: list[str], bucket: str, order: list[str], size: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``size`` in ``group`` up to and including each row, in the order of bucket and ``order``.

    Buckets are summed first; the table of sums has one row a bucket and goes through a window by ``group``.
    """
    sums = df.groupBy(*group, bucket).agg(F.sum(size).alias("_s"))
    before = F.coalesce(F.sum("_s").over(Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(*[F.col(g).alias(f"_{g}") for g in group], F.col(bucket).alias("_b"), before.alias("_o"))
    on = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group] + [F.col(bucket) == F.col("_b")]
    within = F.sum(size).over(Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    joined = df.withColumn("_w", within).join(offsets, on)
    return joined.withColumn(out, F.col("_o") + F.col("_w")).drop("_o", "_w", "_b", *[f"_{g}" for g in group])


def sources_and_budget(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """One row a target source that has tokens: ``source, weight, max_repeats, tokens, budget, most``.

    ``most`` bounds the tokens the mixture can take from the source; it is null where some source runs out before the budget is
    reached, and the others then fill it.

    Weights are the positive target shares of the sources present, made to sum 1. The budget is the given one, or the largest at
    which every one of these sources can still give its share with its repeats: the mixture then meets the targets as nearly as
    the documents' sizes allow.
    """
    t = targets.where("source is not null and target_share > 0").groupBy("source").agg(F.max("target_share").alias("share"),
        F.greatest(F.lit(1), F.max("max_repeats")).alias("max_repeats"))
    have = sized.where("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.max("n_tokens").alias("longest"))
    both = t.join(have, "source")
    every = Window.partitionBy()
    weight = F.col("share") / F.sum("share").over(every)
    w = both.select("source", weight.alias("weight"), "max_repeats", "tokens", F.sum("longest").over(every).alias("slack"))
    reach = F.floor(F.min(F.col("tokens") * F.col("max_repeats") / F.col("weight")).over(every)).cast("long")
    budget = F.lit(total_tokens).cast("long") if total_tokens is not None else F.col("reach")
    # while every source lasts, none passes its share of the budget and of one document of each source
    most = F.when(F.col("reach") >= F.col("budget"), F.col("weight") * (F.col("budget") + F.col("slack")))
    return w.withColumn("reach", reach).withColumn("budget", budget).withColumn("most", most).drop("reach", "slack")


def mix(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 0, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, source, repeat_no, n_tokens, finish, mix_start``: the documents of the mixture, in the order of ``finish``.

    ``sized`` has ``doc_id, source, n_tokens``; ``targets`` has ``source, target_share, max_repeats``; further columns are
    ignored. Whole documents are taken while the tokens before them (``mix_start``) are below the budget. A source without target,
    and a target without documents, have no part; the other weights grow in proportion. Null sources, null or zero sizes and
    non-positive shares are left out; ``max_repeats`` null or below 1 counts as 1. Repeated rows are documents of their own. Ties
    in the shuffle are settled by ``doc_id``. An empty table gives an empty result. The sources must fit a broadcast: at most
    100,000, which is checked.
    """
    plan = cut(sources_and_budget(sized, targets, total_tokens))
    if plan.limit(100_001).count() > 100_000:
        raise ValueError("more than 100000 sources")
    docs = sized.where("n_tokens > 0 and source is not null and doc_id is not null").select("doc_id", "source",
        F.col("n_tokens").cast("long").alias("n_tokens"))
    counts = docs.groupBy("source").agg(F.count("*").alias("n_docs"))
    known = plan.join(counts, "source").select("source", "weight", "max_repeats", "tokens", "budget", "most",
        F.greatest(F.lit(1), F.ceil(F.col("n_docs") / bucket)).cast("long").alias("n_buckets"))
    repeats = F.explode(F.sequence(F.lit(0), F.col("max_repeats") - 1))
    copies = docs.join(F.broadcast(known), "source").select("doc_id", "source", "n_tokens", "weight", "budget", "most", "tokens", "n_buckets",
        repeats.alias("repeat_no"))
    needed = copies.where("most is null or repeat_no * tokens <= most")
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "source", "repeat_no", "doc_id"), 2)
    # the bucket is the hash's range, so buckets follow each other in the shuffled order
    at = F.expr(f"h div ({2**62} div n_buckets + 1) + repeat_no * n_buckets")
    placed = needed.withColumn("h", h).withColumn("b", at)
    timed = _running(placed, ["source"], "b", ["h", "doc_id"], "n_tokens", "upto").withColumn("finish", F.col("upto") / F.col("weight"))
    near = cut(timed.where("most is null or upto - n_tokens <= most").select("doc_id", "source", "repeat_no", "n_tokens", "finish", "budget"))
    # cut at the budget: ranges of the finish time by the share of the budget they cover
    stats = near.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / bucket)).cast("long").alias("n_ranges"), F.max("finish").alias("last"))
    ranged = near.join(F.broadcast(stats)).withColumn("rng", F.least(F.col("n_ranges") - 1,
        F.floor(F.col("finish") / F.col("last") * F.col("n_ranges")).cast("long"))).withColumn("one", F.lit(0))
    served = _running(ranged, ["one"], "rng", ["finish", "source", "repeat_no", "doc_id"], "n_tokens", "served")
    start = F.col("served") - F.col("n_tokens")
    return served.where(start < F.col("budget")).select("doc_id", "source", "repeat_no", "n_tokens", "finish", start.alias("mix_start"))


def mix_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, target_share, docs, tokens, actual_share, repeats``: one row a source on either side, with what it reached;
    ``repeats`` is the largest number of uses of a document."""
    got = mixed.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"), (F.max("repeat_no") + 1).alias("repeats"))
    t = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"))
    both = t.join(got, "source", "full")
    share = F.coalesce("tokens", F.lit(0)) / F.sum("tokens").over(Window.partitionBy())
    return both.select("source", "target_share", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        share.alias("actual_share"), F.coalesce("repeats", F.lit(0)).alias("repeats"))


def mix_audit(mixed: DataFrame, sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, present, on_target, within_repeats`` for each target source.

    Fair queueing serves a source to within its longest document of its share, and the total to within the longest of every
    source; ``on_target`` says so. A source without documents is on target, as the others' weights grow in proportion.
    """
    caps = targets.where("source is not null and target_share > 0").groupBy("source").agg(F.max("target_share").alias("share"),
        F.greatest(F.lit(1), F.max("max_repeats")).alias("cap"))
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), (F.max("repeat_no") + 1).alias("repeats"))
    longest = sized.where("n_tokens > 0").groupBy("source").agg(F.max("n_tokens").alias("longest"))
    every = Window.partitionBy()
    r = caps.join(got, "source", "left").join(longest, "source", "left").withColumn("present", F.col("longest").isNotNull()).withColumn("tokens",
        F.coalesce("tokens", F.lit(0)))
    share = F.col("share") / F.sum(F.when(F.col("present"), F.col("share"))).over(every)
    gap = F.abs(F.col("tokens") - share * F.sum("tokens").over(every))
    near = gap <= F.col("longest") + share * F.sum("longest").over(every)
    return r.select("source", "present", F.coalesce(near | ~F.col("present"), F.lit(True)).alias("on_target"),
        F.coalesce(F.col("repeats") <= F.col("cap"), F.lit(True)).alias("within_repeats"))
