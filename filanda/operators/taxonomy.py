"""A taxonomy of capabilities as keyword sets, and the classification of nodes against it by keyword recall."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filanda.functions import text as T

FIT, NEAR, DOMAIN = 0.15, 0.01, 0.08
REVIEW_MARGIN, REVIEW_TOKENS = 0.05, 1
MAX_KEYWORDS = 90


def keyword_index(pages: DataFrame, most: int = MAX_KEYWORDS) -> DataFrame:
    """``domain, domain_ord, cap_ord, name, keywords, keywords_dropped, overview_excerpt``.

    ``pages``: ``domain, domain_ord, cap_ord, name, overview, tasks, manual_only``. The two sections' tokens are taken in turns, each at its first
    appearance, up to ``most``; a page kept for hand-picked evidence has no keywords.
    """
    all_of = T.interleave(T.index_tokens("overview"), T.index_tokens("tasks"), 2**31 - 1)
    p = pages.withColumn("all_kw", F.when(F.col("manual_only"), F.array().cast("array<string>")).otherwise(all_of))
    excerpt = F.split(F.substring("overview", 1, 150), "\n")[0]
    return p.select("domain", "domain_ord", "cap_ord", "name", F.slice("all_kw", 1, most).alias("keywords"),
        F.greatest(F.lit(0), F.size("all_kw") - most).alias("keywords_dropped"), excerpt.alias("overview_excerpt"))


def scores(nodes: DataFrame, index: DataFrame) -> DataFrame:
    """``node_id, domain, domain_ord, cap_ord, name, score, matched``: the capabilities that share a token with a node.

    ``nodes``: ``node_id, tokens``. Tokens meet keywords by an equi-join; a hot token is reduced before the group-by by its place in one node.
    """
    t = nodes.select("node_id", F.size("tokens").alias("n"), F.explode("tokens").alias("k"))
    k = index.select("domain", "domain_ord", "cap_ord", "name", F.explode("keywords").alias("k")).distinct()
    hit = t.join(k, "k").groupBy("node_id", "n", "domain", "domain_ord", "cap_ord", "name").agg(F.array_sort(F.collect_list("k")).alias("matched"))
    return hit.select("node_id", "domain", "domain_ord", "cap_ord", "name", (F.size("matched") / F.col("n")).alias("score"), "matched")


Scorer = Callable[[DataFrame, DataFrame], DataFrame]


def classify(nodes: DataFrame, index: DataFrame, domains: DataFrame, scorer: Scorer = scores) -> DataFrame:
    """One row a node: winner, runner-up, margin, matched tokens, review flag, domain and bucket.

    ``scorer`` may be any function with the arguments and columns of ``scores``, such as one over embeddings.

    ``domains``: ``domain, domain_ord, keywords``. The winner is the first capability in order of the highest score, the runner-up
    the first of the next. Buckets: ``fit`` from 0.15, ``near`` from 0.01, else ``unclassified``. The domain is the first with the
    highest recall of its own keywords; a winner's domain without any recall takes its place, unless a later domain's recall is
    higher than any before.
    """
    s = scorer(nodes, index)
    order = Window.partitionBy("node_id").orderBy(F.desc("score"), "domain_ord", "cap_ord")
    ranked = s.withColumn("r", F.row_number().over(order)).withColumn("second", F.lead("score").over(order)).withColumn("second_name",
        F.lead("name").over(order))
    best = ranked.where("r = 1").select("node_id", F.col("name").alias("capability"), F.col("domain").alias("cap_domain"),
        F.col("domain_ord").alias("cap_domain_ord"), "score", "second", "second_name", "matched")
    # the fold over domains as events: a domain's record, or a capability's becoming best in a domain without recall; the last event names the domain
    d = scorer(nodes, domains.select(F.col("domain"), "domain_ord", F.lit(-1).alias("cap_ord"), F.col("domain").alias("name"), "keywords"))
    prior = Window.partitionBy("node_id").orderBy("domain_ord", "cap_ord").rowsBetween(Window.unboundedPreceding, -1)
    records = d.withColumn("prev", F.coalesce(F.max("score").over(prior), F.lit(0.0))).where("score > prev").select("node_id", "domain", "domain_ord",
        "cap_ord")
    risen = s.withColumn("prev", F.coalesce(F.max("score").over(prior), F.lit(0.0))).where("score > prev").select("node_id", "domain", "domain_ord",
        "cap_ord")
    forced = risen.join(d.select("node_id", "domain_ord"), ["node_id", "domain_ord"], "left_anti")
    last = records.unionByName(forced.select("node_id", "domain", "domain_ord", "cap_ord")).groupBy("node_id").agg(F.max_by("domain",
        F.struct("domain_ord", "cap_ord")).alias("domain"))
    x = nodes.select("node_id", "tokens").join(best, "node_id", "left").join(last, "node_id", "left")
    score, second = F.coalesce("score", F.lit(0.0)), F.coalesce("second", F.lit(0.0))
    margin = F.round(score - second, 4)
    review = F.col("capability").isNotNull() & ((margin <= REVIEW_MARGIN) | (F.size("matched") <= REVIEW_TOKENS))
    bucket = F.when(score >= FIT, "fit").when(score >= NEAR, "near").otherwise("unclassified")
    return x.select("node_id", "tokens", "capability", "domain", F.round(score, 3).alias("score"), bucket.alias("bucket"), margin.alias("margin"),
        F.col("second_name").alias("runner_up"), F.round(second, 3).alias("runner_up_score"),
        F.coalesce("matched", F.array().cast("array<string>")).alias("matched"), review.alias("needs_review"))


def near_misses(classified: DataFrame, communities: DataFrame, domains: DataFrame) -> DataFrame:
    """One row a community with near misses: its most frequent domain (the first by name among equals), mean score, and whether
    its tokens reach a domain's recall of 0.08.

    ``communities``: ``node_id, community``. ``proposal`` is ``new_capability`` from that recall on, else ``new_domain``.
    """
    near = classified.where("bucket = 'near'").join(communities, "node_id")
    votes = near.groupBy("community", "domain").agg(F.count("*").alias("v"))
    first = votes.groupBy("community").agg(F.min_by("domain", F.struct(-F.col("v"), "domain")).alias("domain"))
    union = near.select("community", F.explode("tokens").alias("k")).distinct().groupBy("community").agg(F.collect_list("k").alias("tokens"))
    stats = near.groupBy("community").agg(F.count("*").alias("nodes"), F.round(F.avg("score"), 4).alias("mean_score"))
    x = stats.join(first, "community").join(union, "community").join(domains.select("domain", "keywords"), "domain", "left")
    recall = T.recall("tokens", F.coalesce("keywords", F.array().cast("array<string>")))
    return x.select("community", "domain", "nodes", "mean_score", F.round(recall, 4).alias("domain_recall"),
        F.when(recall >= DOMAIN, "new_capability").otherwise("new_domain").alias("proposal"))
