"""Publishing evidence on pages: stable ids, a page as a table of blocks, upsert, stale placements, and rendering.

A page is kept as rows ``page, ord, kind, sid, title, body``: ``h2`` opens a section, ``block`` is an H3 with its text, ``text``
anything before. Changes are joins on ``(page, sid)``; a page is rendered by one ordered aggregate. Blocks without anchor were
written by hand and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filanda.functions import text as T

ANCHOR = r"<!-- id:([0-9a-f]{12}) -->"
SECTION = "Evidence"
PLACEHOLDER = "_No evidence yet._"
MAX_PAGES = 10_000


def evidence(fits: DataFrame) -> DataFrame:
    """``page, sid, node_id, title, body``: the block of each placement. ``fits``: ``node_id, page, label, source_file, community, text_preview``.

    The body is at most 300 characters, with an ellipsis if cut, or a placeholder where there is none. A node without label is titled by its id.
    """
    text = T.strip(F.regexp_replace(F.coalesce("text_preview", F.lit("")), r"(?m)^[ \t]*#{1,6}[ \t]+", ""))  # no line of a body opens a section
    title = F.coalesce(F.nullif(T.plain_heading("label"), F.lit("")), F.col("node_id"))
    body = F.when(text == "", PLACEHOLDER).when(F.length(text) > 300, F.concat(F.substring(text, 1, 300), F.lit("…"))).otherwise(text)
    source = F.concat(F.lit("Source: "), F.coalesce("source_file", F.lit("-")), F.lit(" · community "),
        F.coalesce(F.col("community").cast("string"), F.lit("-")))
    sid = T.stable_id("node_id", "page")
    anchor = F.concat(F.lit("<!-- id:"), sid, F.lit(" -->"))
    return fits.select("page", sid.alias("sid"), "node_id", title.alias("title"), F.concat_ws("\n", anchor, source, F.lit(""), body).alias("body"))


def parse_pages(pages: DataFrame) -> DataFrame:
    """Blocks of Markdown pages: ``page, ord, kind, sid, section, title, body``. ``pages``: ``page, markdown``."""
    parts = F.split(F.concat(F.lit("\n"), F.regexp_replace("markdown", "\r\n", "\n")), r"\n(?=#{2,3} )")
    b = pages.select("page", F.posexplode(parts).alias("ord", "raw"))
    head = F.regexp_extract("raw", r"^(#{2,3}) ", 1)
    kind = F.when(head == "##", "h2").when(head == "###", "block").otherwise("text")
    title = F.when(kind != "text", T.strip(F.regexp_extract("raw", r"^#{2,3} ([^\n]*)", 1)))
    sid = F.nullif(F.regexp_extract("raw", ANCHOR, 1), F.lit(""))
    body = F.when(kind != "text", F.regexp_replace("raw", r"^#{2,3} [^\n]*\n?", "")).otherwise(F.col("raw"))
    rows = b.select("page", "ord", kind.alias("kind"), sid.alias("sid"), title.alias("title"), T.strip(body).alias("body"))
    return rows.withColumn("section", F.expr("last_value(if(kind = 'h2', title, null), true) over (partition by page order by ord)"))


def upsert(blocks: DataFrame, wanted: DataFrame, section: str = SECTION) -> DataFrame:
    """``page, sid, action``: ``inject`` for new evidence, ``refresh`` for changed, ``skip`` for unchanged. ``wanted``: rows of ``evidence``."""
    there = blocks.where("sid is not null").select("page", "sid", F.col("title").alias("old_title"), F.col("body").alias("old_body"))
    j = wanted.join(there, ["page", "sid"], "left")
    same = F.col("old_title").eqNullSafe(F.col("title")) & F.col("old_body").eqNullSafe(T.strip("body"))
    return j.select("page", "sid", F.when(F.col("old_body").isNull(), "inject").when(same, "skip").otherwise("refresh").alias("action"))


def stale(blocks: DataFrame, known: DataFrame, expected: DataFrame, published: DataFrame | None = None) -> DataFrame:
    """``page, sid, node_id, reason, moved_to``: anchors of known nodes on pages where they are not expected.

    ``known``: ``node_id``; ``expected``: ``node_id, page``. Anchors of nodes not known belong to another corpus and stay.
    ``published`` (``page, sid, node_id``) is the record of what was published, as ``evidence`` gives it, and is joined by
    equality. Without such a record an id says nothing of its node, so each known node's ids on the pages with anchors are
    computed; the pages are those of the taxonomy, at most ``MAX_PAGES``, which is checked.
    """
    anchors = blocks.where("sid is not null").select("page", "sid").distinct()
    if published is not None:
        ids = published.select("page", "sid", "node_id").distinct().join(known.select("node_id").distinct(), "node_id", "left_semi")
    else:
        pages = anchors.select("page").distinct().agg(F.collect_list("page").alias("pages"))
        pages = pages.withColumn("pages", F.when(F.size("pages") > MAX_PAGES,
            F.raise_error(F.lit(f"more than {MAX_PAGES} pages"))).otherwise(F.col("pages")))
        tried = known.select("node_id").distinct().join(F.broadcast(pages)).select("node_id", F.explode("pages").alias("page"))
        ids = tried.withColumn("sid", T.stable_id("node_id", "page"))
    placed = ids.join(anchors, ["page", "sid"])
    lost = placed.join(expected.select("node_id", "page"), ["node_id", "page"], "left_anti")
    moved = expected.groupBy("node_id").agg(F.array_sort(F.collect_set("page")).alias("moved_to"))
    j = lost.join(moved, "node_id", "left")
    return j.select("page", "sid", "node_id", F.when(F.col("moved_to").isNull(), "withdrawn").otherwise("moved").alias("reason"),
        F.coalesce("moved_to", F.array().cast("array<string>")).alias("moved_to"))


def apply(blocks: DataFrame, wanted: DataFrame, stale_rows: DataFrame | None = None, section: str = SECTION) -> DataFrame:
    """``page, markdown``: pages with evidence injected at the end of its section or refreshed in place, and stale evidence removed.

    A page without the section gets it at the end; a section left without blocks gets a placeholder.
    """
    keep = blocks if stale_rows is None else blocks.join(stale_rows.select("page", "sid"), ["page", "sid"], "left_anti")
    new = wanted.select("page", "sid", F.col("title").alias("new_title"), T.strip("body").alias("new_body"))
    old = keep.join(new, ["page", "sid"], "left").select("page", "ord", "kind", "sid", F.coalesce("new_title", "title").alias("title"),
        F.coalesce("new_body", "body").alias("body"), "section")
    added = new.join(keep.where("sid is not null").select("page", "sid"), ["page", "sid"], "left_anti")
    ends = keep.groupBy("page").agg(F.max(F.when(F.col("section") == section, F.col("ord"))).alias("at"), F.max("ord").alias("last"))
    at = F.coalesce("at", F.col("last") + 1)
    inserted = added.join(ends, "page").select("page", at.alias("ord"), F.lit("block").alias("kind"), "sid", F.col("new_title").alias("title"),
        F.col("new_body").alias("body"))
    opened = inserted.join(ends.where("at is null").select("page", "last"),
        "page").groupBy("page").agg((F.max("last") + 1).alias("ord")).select("page", "ord", F.lit("h2").alias("kind"),
        F.lit(None).cast("string").alias("sid"), F.lit(section).alias("title"), F.lit("").alias("body"))
    rows = old.drop("section").withColumn("late", F.lit(0)).unionByName(opened.withColumn("late", F.lit(1))).unionByName(inserted.withColumn("late",
        F.lit(2)))
    heading = F.when(F.col("kind") == "h2", F.concat(F.lit("## "), "title")).when(F.col("kind") == "block", F.concat(F.lit("### "), "title"))
    filled = F.sum(F.when((F.col("kind") == "block"), 1).otherwise(0)).over(Window.partitionBy("page"))
    empty = (F.col("kind") == "h2") & (F.col("title") == section) & (F.col("body") == "") & (filled == 0)
    text = F.concat_ws("\n", heading, F.nullif(F.when(empty, PLACEHOLDER).otherwise(F.col("body")), F.lit("")))
    lines = rows.withColumn("text", text).where("text <> ''")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "late", "sid", "text"))), lambda x: x["text"]), "\n\n")
    return lines.groupBy("page").agg(F.concat(joined, F.lit("\n")).alias("markdown"))


def new_page(groups: DataFrame, most: int = 10) -> DataFrame:
    """``page, markdown``: the first page of each proposed capability that has none, with its four sections. ``groups``: ``name,
    domain, label, text_preview, ord``, one row a node, already anonymised.

    The page's name is the slug of the name; the first preview in order goes into the overview, the first ``most`` labels into the
    scope. Groups of one slug are one page, under the smallest name.
    """
    g = groups.where("name is not null").withColumn("page", T.slug("name"))
    rank = F.row_number().over(Window.partitionBy("page").orderBy("ord", "label"))
    first = g.where("label <> ''").select("page", "ord", "label").withColumn("r", rank).where(F.col("r") <= most)
    labels = first.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("r", "label"))).alias("labels"))
    p = F.regexp_replace(F.substring("text_preview", 1, 80), "\n", " ")
    preview = F.min(F.when(F.col("text_preview") != "", F.struct("ord", p.alias("p")))).getField("p")
    per = g.groupBy("page").agg(F.min("name").alias("name"), F.min("domain").alias("domain"), preview.alias("preview")).join(labels, "page", "left")
    overview = F.concat(F.lit("*Capability proposed from documents.*\nDomain: **"), F.coalesce("domain", F.lit("-")), F.lit("**."),
        F.coalesce(F.concat(F.lit("\nPreview: "), "preview"), F.lit("")))
    scope = F.coalesce(F.array_join(F.transform("labels", lambda x: F.concat(F.lit("- "), x["label"])), "\n"), F.lit(""))
    parts = [F.concat(F.lit("# "), "name"), F.lit("## Overview"), overview, F.lit("## Technologies & tools"), F.lit(PLACEHOLDER),
        F.lit("## Responsibilities & operational scope"), scope, F.lit(f"## {SECTION}"), F.lit(PLACEHOLDER)]
    return per.select("page", F.concat(F.array_join(F.filter(F.array(*parts), lambda x: x != ""), "\n\n"), F.lit("\n")).alias("markdown"))


def missing_pages(proposed: DataFrame, pages: DataFrame) -> DataFrame:
    """The proposed pages that do not exist yet; both have ``page``."""
    return proposed.join(pages.select("page").distinct(), "page", "left_anti")


# The locales that a page may have beside its default.
LOCALES = ("it", "en", "es")


def locale_variants(pages: DataFrame) -> DataFrame:
    """``base, locale, page``: each page under its name without locale; the default page has none. ``pages``: ``page``, such as
    ``rete`` or ``rete.en``."""
    locale = F.regexp_extract("page", r"\.(" + "|".join(LOCALES) + ")$", 1)
    base = F.regexp_replace("page", r"\.(" + "|".join(LOCALES) + ")$", "")
    return pages.select(base.alias("base"), F.nullif(locale, F.lit("")).alias("locale"), "page").distinct()


def on_variants(wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows of ``wanted`` (by ``page``, a default page) once for each variant of their page that exists; those of a page that does
    not exist are left out."""
    v = locale_variants(pages).select("base", F.col("page").alias("_page"))
    return wanted.join(v, F.col("page") == F.col("base")).drop("page", "base").withColumnRenamed("_page", "page").select(wanted.columns)


def repair(blocks: DataFrame, section: str = SECTION,
    prose: str = r"(?i)\b(?:in data\s+\d|please complete|si e' scritto|e' stato creato|in alternativa dal)") -> DataFrame:
    """``blocks`` without prose headings inside the section: headings of level 2 that a flattened text opened there by mistake
    become text of the block before them.

    What follows such a heading belongs to the section again. Blocks without anchor, and headings elsewhere, stay.
    """
    order = Window.partitionBy("page").orderBy("ord")
    wrong = (F.col("kind") == "h2") & F.col("title").rlike(prose)
    kept = F.when(~wrong & (F.col("kind") == "h2"), F.col("title"))
    b = blocks.withColumn("wrong", F.coalesce(wrong, F.lit(False))).withColumn("section", F.last(kept, True).over(order))
    b = b.withColumn("wrong", F.col("wrong") & (F.col("section") == section))
    carried = F.concat_ws("\n\n", F.col("body"), F.lead(F.when(F.col("wrong"), F.col("body"))).over(order))
    follows = F.coalesce(F.lead("wrong").over(order), F.lit(False))
    return b.withColumn("body", F.when(follows, F.trim(carried)).otherwise(F.col("body"))).where("not wrong").drop("wrong")
