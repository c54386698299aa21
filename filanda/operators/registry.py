"""A registry of work items kept as JSON lines, JSON files of the stages, and lists of paths: reading, counting, comparing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATES = ("todo", "doing", "done", "skipped", "error")
REGISTRY = "id string, source string, hash string, state string, agent string, artifact string, note string, updated string"


def parse_lines(lines: DataFrame, schema: str = REGISTRY, value: str = "value") -> DataFrame:
    """``lines`` with ``item`` (a struct by ``schema``, null if malformed) and ``malformed``.

    A byte order mark before a line and blank lines are left out; a line that is no JSON object, or a cut-off one, is reported and
    not dropped in silence. Unknown fields are ignored, missing ones null. An empty table gives an empty result.
    """
    text = F.trim(F.regexp_replace(value, "^﻿", ""))
    kept = lines.where(value + " is not null").withColumn(value, text).where(F.col(value) != "")
    parsed = F.from_json(F.col(value), T._parse_datatype_string(schema + ", _bad string"),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    whole = kept.withColumn("_p", parsed)
    bad = F.col("_p").isNull() | F.col("_p._bad").isNotNull() | ~F.col(value).startswith("{")
    names = [f.name for f in T._parse_datatype_string(schema)]
    return whole.withColumn("malformed", bad).withColumn("item", F.when(~F.col("malformed"),
        F.struct(*[F.col(f"_p.{n}").alias(n) for n in names]))).drop("_p")


def read_stage(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The whole-file JSON objects of a stage, one row a file; a file that is none fails the read."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def state_counts(verdicts: DataFrame) -> DataFrame:
    """One row: items in all and by state, those verified, left, discrepant, to be done again, and not verifiable. ``verdicts``:
    ``id, state, verdict``."""
    n = lambda c: F.count_if(c)
    v, s = F.col("verdict"), F.col("state")
    wrong = v.isin("artifact-missing", "artifact-too-small", "skipped-without-note")
    by_state = [n(s == x).alias(x) for x in STATES]
    return verdicts.agg(F.count("*").alias("items"), *by_state, n(s.isNull() | ~s.isin(*STATES)).alias("unknown"),
        n(v == "verified").alias("verified"), n(~s.isin("done", "skipped")).alias("left"), n(wrong).alias("discrepant"),
        n(v == "source-changed").alias("again"), n(v == "source-unverifiable").alias("unverifiable"))


def next_items(items: DataFrame, most: int, agent: str | None = None) -> DataFrame:
    """The ``most`` first items by id that are to do or being done, of one agent if named; items of no agent are anybody's.
    ``items``: ``id, state, agent``."""
    mine = items.where(F.col("state").isin("todo", "doing"))
    if agent is not None:
        mine = mine.where(F.coalesce("agent", F.lit(agent)) == agent)
    return mine.orderBy("id").limit(most)


def wrapper_changes(expected: DataFrame, present: DataFrame) -> DataFrame:
    """``path, action``: ``create``, ``update`` or ``orphan`` for generated files that differ from what they should be.

    ``expected``: ``path, content``; ``present``: ``path, content, generated``. A file that is not generated is nobody's orphan,
    and is updated where one is expected in its place.
    """
    e = expected.select("path", F.col("content").alias("want"), F.lit(True).alias("wanted"))
    p = present.select("path", F.col("content").alias("have"), "generated", F.lit(True).alias("there"))
    j = e.join(p, "path", "full")
    action = F.when(F.col("there").isNull(), "create").when(F.col("wanted").isNull() & F.col("generated"),
        "orphan").when(F.col("wanted") & ~F.col("want").eqNullSafe(F.col("have")), "update")
    return j.select("path", action.alias("action")).where("action is not null")


def path_areas(paths: DataFrame, most: int = 10) -> DataFrame:
    """``area, n_paths, confirm``: paths by their first folder, ``(root)`` for those without; ``confirm`` if there are more than
    ``most`` paths or more than one area."""
    p = paths.where("path is not null").select("path").distinct()
    area = F.when(F.contains("path", F.lit("/")), F.substring_index("path", "/", 1)).otherwise("(root)")
    per = p.groupBy(area.alias("area")).agg(F.count("*").alias("n_paths"))
    total = per.agg(F.sum("n_paths").alias("all_paths"), F.count("*").alias("areas"))  # one row
    return per.join(F.broadcast(total)).select("area", "n_paths", ((F.col("all_paths") > most) | (F.col("areas") > 1)).alias("confirm"))


def listed_paths(tracked: DataFrame, untracked: DataFrame) -> DataFrame:
    """``path, tracked, untracked``: the union of two lists of paths, each path once."""
    both = tracked.select("path", F.lit(True).alias("t")).unionByName(untracked.select("path", F.lit(False).alias("t"))).where("path is not null")
    return both.groupBy("path").agg(F.bool_or("t").alias("tracked"), F.bool_or(~F.col("t")).alias("untracked"))


# Words in file names that give away a secret, and what stands for them, in this order.
NAME_SUBSTITUTIONS = [
    (r"private[_-]?keys?", "chiave-privata"), (r"passwords?", "autenticazione"), (r"passwd", "autenticazione"), (r"credentials?", "accesso"),
        (r"secrets?", "riservato"), (r"tokens?", "chiave"),
]


def sanitize_stem(stem: Column) -> Column:
    """A file's stem with telling words replaced, in any case."""
    for pattern, word in NAME_SUBSTITUTIONS:
        stem = F.regexp_replace(stem, "(?i)" + pattern, word)
    return stem


def sanitized_markdown(docs: DataFrame) -> DataFrame:
    """``doc_id, file_name, markdown, error``: a note with front matter, heading and body under a neutral name; ``error`` names
    what is still telling in it. ``docs``: ``doc_id, name, text``.

    A document without text has ``empty``, its markdown null; the others go on.
    """
    stem = F.regexp_replace("name", r"(?<=.)\.[^.]*$", "")
    clean = sanitize_stem(stem)
    telling = clean.rlike("(?i)" + "|".join(p for p, _ in NAME_SUBSTITUTIONS))
    head = F.concat(F.lit("---\nsource: "), clean, F.lit("\n---\n\n# "), clean, F.lit("\n\n"))
    empty = F.coalesce(F.trim("text"), F.lit("")) == ""
    return docs.select("doc_id", F.concat(clean, F.lit(".md")).alias("file_name"),
        F.when(~empty, F.concat(head, "text", F.lit("\n"))).alias("markdown"), F.when(empty, "empty").when(telling, "telling-name").alias("error"))


def collect_text(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, text``: all text of a document's sections in their order: title, both previews, paragraphs and, where there is a
    column ``tables``, its cells; blank parts dropped, one a line.

    ``sections``: ``doc_id, section_id, ord, title, preview_start, preview_end, paragraphs``; exact copies of a section count
    once. A document whose parts are all blank has an empty text.
    """
    none = F.array().cast("array<string>")
    cells = F.coalesce(F.flatten(F.flatten(F.transform("tables", lambda t: F.transform(t, F.map_values)))),
        none) if "tables" in sections.columns else none
    parts = F.concat(F.array("title", "preview_start", "preview_end"), F.coalesce("paragraphs", none), cells)
    s = sections.select(key, "section_id", "ord", F.array_join(F.filter(parts, lambda x: x != ""), "\n").alias("t"))
    one = s.groupBy(key, "section_id").agg(F.min(F.struct("ord", "t")).alias("x"))
    lists = one.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("x.ord", "section_id", "x.t"))).alias("xs"))
    return lists.select(key, F.array_join(F.filter(F.transform("xs", lambda x: x["t"]), lambda t: t != ""), "\n").alias("text"))
