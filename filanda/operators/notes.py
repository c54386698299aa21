"""A vault of linked notes: links from previews to other documents, note texts, and an index; and JSON exports."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filanda.functions import text as T


def link_candidates(previews: DataFrame, titles: DataFrame, least: int = 4) -> DataFrame:
    """``doc_id, token, target``: title words of other documents that a preview holds. ``previews``: ``doc_id, text``; ``titles``: ``doc_id, name``.

    A word of many titles names none of them: words met in more than one title are left out, which also bounds the join.
    """
    words = titles.select(F.col("doc_id").alias("target"), F.explode(T.title_tokens("name")).alias("token")).where(F.length("token") >= least)
    single = words.groupBy("token").agg(F.min("target").alias("target"), F.count("*").alias("n")).where("n = 1").drop("n")
    seen = previews.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9]+)"), F.lit(1))))
        .alias("token"))
    return seen.join(single, "token").where("doc_id <> target").select("doc_id", "token", "target")


def title_links(previews: DataFrame, titles: DataFrame, least: int = 4) -> DataFrame:
    """``doc_id, token, target``: every other document that has a word of a document's previews in its title, however many share it.

    A document may have several previews; null texts and names give nothing. The rows grow with the square of a corpus that shares title words.
    """
    words = titles.select(F.col("doc_id").alias("target"), F.explode(T.title_tokens("name")).alias("token")).where(F.length("token") >= least)
    seen = previews.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9]+)"), F.lit(1))))
        .alias("token")).distinct()
    return seen.join(words, "token").where("doc_id <> target").select("doc_id", "token", "target")


def title_words(titles: DataFrame, least: int = 4) -> DataFrame:
    """``token, target``: the words of titles that a text may be linked by, each with every document it names."""
    return titles.where("doc_id is not null").select(F.col("doc_id").alias("target"),
        F.explode(T.title_tokens("name")).alias("token")).where(F.length("token") >= least).select("token", "target").distinct()


def linked_words(previews: DataFrame, titles: DataFrame, least: int = 4) -> DataFrame:
    """``doc_id, token, n_targets``: the words of a document's previews that other documents have in their title, with the number of these.

    Together with ``title_words`` this holds every link of ``title_links`` without its pairs: the rows grow with the texts,
    however many titles share a word.
    """
    words = title_words(titles, least)
    seen = previews.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9]+)"), F.lit(1))))
        .alias("token")).where(F.length("token") >= least).distinct()
    own = words.select(F.col("target").alias("doc_id"), "token", F.lit(1).alias("own"))
    many = seen.join(words.groupBy("token").agg(F.count("*").alias("n")), "token").join(own, ["doc_id", "token"], "left")
    return many.select("doc_id", "token", (F.col("n") - F.coalesce("own", F.lit(0))).alias("n_targets")).where("n_targets > 0")


def insert_links(text: str | None, links: list[tuple[str, str]]) -> str | None:
    """Wiki links for tokens, the longest first, at most one a target, at the token's first place outside a link, in any case."""
    if not text:
        return text
    done: set[str] = set()
    for token, target in sorted(links, key=lambda x: (-len(x[0]), x)):
        if target in done:
            continue
        spans = [m.span() for m in re.finditer(r"\[\[.*?\]\]", text)]
        for m in re.finditer(rf"(?<![A-Za-z0-9]){re.escape(token)}(?![A-Za-z0-9])", text, re.I):
            if not any(a <= m.start() < b for a, b in spans):
                text = f"{text[: m.start()]}[[{target}|{m.group()}]]{text[m.end() :]}"
                done.add(target)
                break
    return text


def linked_previews(previews: DataFrame, titles: DataFrame, shared: bool = False) -> DataFrame:
    """``doc_id, text``: previews with links to the documents whose titles they name; with ``shared``, by words of several titles too."""
    names = titles.select(F.col("doc_id").alias("target"), T.safe_stem("name").alias("stem"))
    c = (title_links if shared else link_candidates)(previews, titles).join(names,
        "target").groupBy("doc_id").agg(F.collect_list(F.struct("token", "stem")).alias("links"))

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield pd.DataFrame({"doc_id": p["doc_id"], "text": [insert_links(t,
                [(x["token"], x["stem"]) for x in ls] if ls is not None else []) for t, ls in zip(p["text"], p["links"], strict=True)]})

    kind = dict(previews.dtypes)["doc_id"]
    return previews.join(c, "doc_id", "left").select("doc_id", "text", "links").mapInPandas(fold, f"doc_id {kind}, text string")


def render_notes(heads: DataFrame, bodies: DataFrame, neighbours: DataFrame, titles: DataFrame) -> DataFrame:
    """``doc_id, note``: front matter, preview, and links to the nearest documents with weight and label."""
    stem = titles.select(F.col("doc_id").alias("neighbour"), T.safe_stem("name").alias("stem"))
    line = F.format_string("- [[%s]] (%.2f, %s)", F.col("stem"), F.col("weight"), F.col("label"))
    near = neighbours.join(stem, "neighbour").groupBy(F.col("node").alias("doc_id")).agg(F
        .array_join(F.transform(F.array_sort(F.collect_list(F.struct("rnk", line.alias("l")))), lambda x: x["l"]), "\n").alias("near"))
    j = heads.join(bodies, "doc_id", "left").join(near, "doc_id", "left")
    return j.select("doc_id", F.concat_ws("\n\n", "head", F.nullif(F.col("text"), F.lit("")),
        F.concat(F.lit("## Related\n\n"), "near")).alias("note"))


def index_sections(docs: DataFrame, shown: int = 50) -> DataFrame:
    """``doc_type, n_docs, listing``: documents by type, the first ``shown`` names of each listed in order. ``docs``: ``doc_id, name``."""
    t = docs.select("name", T.doc_type("name").alias("doc_type"))
    r = F.row_number().over(Window.partitionBy("doc_type").orderBy("name"))
    # numbers by a partial aggregate; the window keeps no more than ``shown`` rows a type before its shuffle
    numbers = t.groupBy("doc_type").agg(F.count("*").alias("n_docs"))
    top = t.withColumn("r", r).where(F.col("r") <= shown)
    lists = top.groupBy("doc_type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "name"))),
        lambda x: F.concat(F.lit("- "), x["name"])), "\n").alias("listing"))
    return lists.join(numbers, "doc_type").select("doc_type", "n_docs", "listing")


def review_report(classified: DataFrame) -> DataFrame:
    """``domain, capability, line``: one Markdown line a fit, those to review marked."""
    mark = F.when(F.col("needs_review"), F.lit(" **review**")).otherwise(F.lit(""))
    line = F.concat(F.lit("- "), "node_id", F.format_string(" (%.3f, margin %.4f)", F.col("score"), F.col("margin")), mark)
    return classified.where("bucket = 'fit'").select("domain", "capability", line.alias("line"))


def report_parts(classified: DataFrame, proposals: DataFrame) -> DataFrame:
    """``part, head, place, line``: a review report as lines in order: the counts, the fits under their capability, proposed
    capabilities by falling recall, proposed domains, and what is left.

    ``proposals`` are rows of ``near_misses``. Each part's lines have their own numbers, by a window over one capability, so no
    part passes through one task as a whole.
    """
    counts = classified.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("needs_review").alias("r"))
    summary = counts.select(F.lit("1 summary").alias("part"), F.lit("").alias("head"), F.col("bucket").alias("o"),
        F.format_string("| %s | %d | %d |", "bucket", "n", "r").alias("line"))
    head = F.concat(F.lit("["), F.coalesce("domain", F.lit("-")), F.lit("] "), F.coalesce("capability", F.lit("-")))
    score = F.format_string("%08.3f", F.lit(1000) - F.col("score"))
    mark = F.when(F.col("needs_review"), F.lit(" **review**")).otherwise(F.lit(""))
    fit_line = F.concat(F.lit("- "), "node_id", F.format_string(" (%.3f, margin %.4f)", F.col("score"), F.col("margin")), mark)
    fits = classified.where("bucket = 'fit'").select(F.lit("2 fits").alias("part"), head.alias("head"), F.concat(score, "node_id").alias("o"),
        fit_line.alias("line"))
    new = proposals.select(F.when(F.col("proposal") == "new_capability", "3 new capabilities").otherwise("4 new domains").alias("part"),
        F.lit("").alias("head"), F.concat(F.format_string("%08.4f", F.lit(1000) - F.col("domain_recall")),
        F.format_string("%012d", F.col("community").cast("long"))).alias("o"),
        F.format_string("- community %d: %d nodes, mean %.4f, recall %.4f", F.col("community").cast("long"), "nodes", "mean_score",
        "domain_recall").alias("line"))
    left = classified.where("bucket = 'unclassified'").select(F.lit("5 unclassified").alias("part"), F.substring("node_id", 1, 1).alias("head"),
        F.col("node_id").alias("o"), F.concat(F.lit("- "), "node_id").alias("line"))
    every = summary.unionByName(fits).unionByName(new).unionByName(left)
    return every.select("part", "head", F.row_number().over(Window.partitionBy("part", "head").orderBy("o")).alias("place"), "line")


def export_json(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Rows as JSON lines; an existing export is an error unless it may be overwritten."""
    df.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def export_documents(df: DataFrame, path: str, stem: str = "stem") -> None:
    """One folder of JSON lines for each stem, by the stem's safe form."""
    df.withColumn("_stem", F.regexp_replace(stem, r"(?U)[^\w\-.]", "_")).write.mode("overwrite").partitionBy("_stem").json(path)


def corpus_envelope(docs: DataFrame) -> DataFrame:
    """One row: ``document_count, total_words, total_estimated_tokens``. ``docs``: ``total_words, estimated_tokens``."""
    return docs.agg(F.count("*").alias("document_count"), F.coalesce(F.sum("total_words"), F.lit(0)).alias("total_words"),
        F.coalesce(F.sum("estimated_tokens"), F.lit(0)).alias("total_estimated_tokens"))
