"""Audits: leaks in a tree and its history, a registry of work items, budgets of text, and incremental merges."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filanda.functions import text as T
from filanda.operators.gate import RESIDUE, SECRET_PARTS, SECRETS, Rule

# Extensions of text files.
TEXT_SUFFIXES = "md txt py sh ps1 json jsonl yml yaml toml html css js csv ini cfg".split()


def may_match(rule: str, text: str = "text") -> Column:
    """A cheap test that every text with a match of a known rule passes; true for other rules."""
    low = F.lower(F.col(text))
    if rule.startswith("secret-"):
        return functools.reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in SECRET_PARTS])
    if rule == "residue-email":
        return F.contains(F.col(text), F.lit("@"))
    if rule == "residue-ip-abbreviated":
        return F.contains(F.col(text), F.lit("(."))
    return F.lit(True)


def leak_findings(files: DataFrame, rules: list[Rule] | None = None, allowed: list[str] | None = None, benign: str | None = None) -> DataFrame:
    """``path, category, value``: distinct matches, their first 80 characters. ``files``: ``path, text``.

    Files of other than text suffixes are skipped; values that are allowed, or match ``benign``, are no findings.
    """
    suffix = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    texts = files.where(suffix.isin(*TEXT_SUFFIXES) & F.col("text").isNotNull())
    none = F.array().cast("array<string>")
    found_by = lambda n, p: F.when(may_match(n), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none)
    per = F.array(*[F.struct(F.lit(n).alias("category"), found_by(n, p).alias("vs")) for n, p in rules or [*SECRETS, *RESIDUE]])
    found = texts.select("path", F.explode(per).alias("x")).select("path", "x.category", F.explode("x.vs").alias("value"))
    if allowed:
        found = found.where(~F.col("value").isin(*allowed))
    if benign:
        found = found.where(~F.col("value").rlike(benign))
    return found.select("path", "category", F.substring("value", 1, 80).alias("value")).distinct()


def history_blobs(blobs: DataFrame) -> DataFrame:
    """``blob_sha, path, text``: each distinct blob once, under the path it first came by. ``blobs``: ``commit_no, blob_sha, path, text``."""
    return blobs.groupBy("blob_sha").agg(F.min_by(F.struct("path", "text"), F.struct("commit_no", "path")).alias("x")).select("blob_sha", "x.path",
        "x.text")


def registry_status(items: DataFrame, artifacts: DataFrame, sources: DataFrame, least_bytes: int = 32) -> DataFrame:
    """``id, state, verdict``: what a declared state is worth.

    ``items``: ``id, state, artifact, source, hash, note``; ``artifacts``: ``artifact, n_bytes``; ``sources``: ``source,
    hash_now``. ``done`` needs an artifact of at least ``least_bytes`` and an unchanged source; ``skipped`` needs a note.
    """
    j = items.join(artifacts, "artifact", "left").join(sources, "source", "left")
    done = F.col("state") == "done"
    verdict = (
        F.when(done & F.col("n_bytes").isNull(), "artifact-missing")
        .when(done & (F.col("n_bytes") < least_bytes), "artifact-too-small")
        .when(done & F.col("hash_now").isNull(), "source-unverifiable")
        .when(done & (F.col("hash_now") != F.col("hash")), "source-changed")
        .when((F.col("state") == "skipped") & (F.coalesce(F.trim("note"), F.lit("")) == ""), "skipped-without-note")
        .when(done, "verified")
        .otherwise("open")
    )
    return j.select("id", "state", verdict.alias("verdict"))


def text_budget(files: DataFrame, baseline: DataFrame, per_file: int, total: int) -> DataFrame:
    """``path, n_chars, growth, over_file, over_total``. ``files``: ``path, text, conditional``; ``baseline``: ``path, n_chars``.

    Conditional files do not count towards the total; growth is against the baseline, the whole size for a new file.
    """
    n = F.coalesce(F.length("text"), F.lit(0))
    f = files.select("path", n.alias("n_chars"), "conditional").join(baseline.select("path", F.col("n_chars").alias("was")), "path", "left")
    size = F.when(F.col("conditional"), 0).otherwise(F.coalesce(F.length("text"), F.lit(0)))
    whole = files.agg(F.coalesce(F.sum(size), F.lit(0)).alias("all_of"))  # one row
    return f.crossJoin(F.broadcast(whole)).select("path", "n_chars", (F.col("n_chars") - F.coalesce("was", F.lit(0))).alias("growth"),
        (F.col("n_chars") > per_file).alias("over_file"), (F.col("all_of") > total).alias("over_total"))


def changed_files(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Rows of ``current`` (``key, file_hash`` and others) that ``previous`` does not hold with this hash; null hashes are alike."""
    p = previous.select(F.col("key").alias("_k"), F.col("file_hash").alias("_h"))
    return current.join(p, (F.col("key") == F.col("_k")) & F.col("file_hash").eqNullSafe(F.col("_h")), "left_anti")


def incremental_merge(previous: DataFrame, parsed: DataFrame, present: DataFrame) -> DataFrame:
    """Previous rows that were not parsed again, and the parsed ones, of keys still present. All by ``key``."""
    kept = previous.join(parsed.select("key"), "key", "left_anti").unionByName(parsed)
    return kept.join(present.select("key"), "key", "left_semi")


def scope_check(declared: DataFrame, dirty: DataFrame) -> DataFrame:
    """``path, status``: dirty paths outside the declared scope, and declared paths without change. Both have ``path``; a declared
    path that ends in ``/`` covers all below it."""
    tree = F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("path", "/"))),
        lambda i: F.concat(F.array_join(F.slice(F.split("path", "/"), 1, i), "/"),
        F.when(i < F.size(F.split("path", "/")), F.lit("/")).otherwise(F.lit("")))))
    covers = dirty.select("path", tree.alias("scope"))
    hit = covers.join(declared.select(F.col("path").alias("scope")), "scope")
    outside = dirty.join(hit.select("path"), "path", "left_anti").select("path", F.lit("outside").alias("status"))
    unused = declared.join(hit.select(F.col("scope").alias("path")), "path", "left_anti").select("path", F.lit("missing").alias("status"))
    return outside.unionByName(unused)


def uniformity(values: DataFrame, group: str, value: str) -> DataFrame:
    """``group, n, cv``: population coefficient of variation; null for fewer than two values or a mean of zero."""
    g = values.groupBy(group).agg(F.count(value).alias("n"), F.stddev_pop(value).alias("s"), F.avg(value).alias("m"))
    return g.select(group, "n", F.when((F.col("n") >= 2) & (F.col("m") != 0), F.round(F.col("s") / F.col("m"), 6)).alias("cv"))


def tree_fingerprint(files: DataFrame) -> DataFrame:
    """One row: ``fingerprint``, 16 digits over the sorted lines ``path hash``. The lines are hashed first and combined in order
    of a digest for each bucket, so no task holds all."""
    lines = files.select(F.concat_ws(" ", "path", "file_hash").alias("l"))
    buckets = lines.groupBy(F.substring(F.sha2("l", 256), 1, 2).alias("b")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.sha2("l", 256))),
        ""), 256).alias("h"))
    return buckets.agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("b", "h"))), ""), 256), 1, 16).alias("fingerprint"))


def word_runs(texts: DataFrame, key: str = "doc_id", text: str = "text", short: int = 6) -> DataFrame:
    """``key, para_no``: paragraphs with three sentences in a row of fewer than ``short`` words; one row a paragraph."""
    para = texts.select(key, F.posexplode(F.split(text, "\n")).alias("para_no", "p"))
    s = para.select(key, "para_no", F.posexplode(F.split("p", r"(?<=[.!?])\s+")).alias("s_no", "s")).where("s <> ''").withColumn("few",
        T.word_count("s") < short)
    w = Window.partitionBy(key, "para_no").orderBy("s_no")
    return s.withColumn("run", F.col("few") & F.lead("few", 1).over(w) & F.lead("few", 2).over(w)).where("run").select(key, "para_no").distinct()
