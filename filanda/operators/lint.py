"""Checks of Markdown and prose as rows of findings: tables, shell blocks, prose families, placeholders, front matter, drafts, progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filanda.functions import text as T
from filanda.functions import typography as Y


def numbered_lines(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """``key, line_no, line, in_code``: lines from 1; ``in_code`` inside fences, the fence lines themselves included."""
    lines = texts.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n")).alias("n", "line")).withColumn("line_no",
        F.col("n") + 1)
    fence = F.col("line").rlike(r"^\s*(```|~~~)")
    opened = F.sum(fence.cast("int")).over(Window.partitionBy(key).orderBy("line_no"))
    return lines.select(key, "line_no", "line", ((opened % 2 == 1) | fence).alias("in_code"))


def table_defects(texts: DataFrame, key: str = "path") -> DataFrame:
    """``key, line_no, defect``: rows of a table whose cells differ in number from its rule (``cells``), and rows of a run without
    rule (``detached``).

    A table is a run of rows that begin and end with a pipe; a run drawn with ``+--`` lines is a figure and has no defects; code is skipped.
    """
    l = numbered_lines(texts, key).where("not in_code").where(Y.is_table_row("line") | F.col("line").rlike(r"^\s*\+[-=+]+\+\s*$"))
    run = F.col("line_no") - F.row_number().over(Window.partitionBy(key).orderBy("line_no"))
    w = Window.partitionBy(key, "run")
    rule = F.col("line").rlike(r"^\s*\|[\s:|-]*-[\s:|-]*\|\s*$")
    x = l.withColumn("run", run).withColumn("figure", F.max(F.col("line").rlike(r"^\s*\+")).over(w)).withColumn("want",
        F.max(F.when(rule, Y.cell_count("line"))).over(w)).where("not figure")
    return x.select(key, "line_no", F.when(F.col("want").isNull(), "detached").when(Y.cell_count("line") != F.col("want"),
        "cells").alias("defect")).where("defect is not null")


def shell_defects(texts: DataFrame, key: str = "path") -> DataFrame:
    """``key, line_no, defect``: in fenced shell blocks, a continuation at the block's end (``open-continuation``) or followed by
    a blank line (``broken-continuation``), and PowerShell's back-tick in a POSIX block (``wrong-continuation``)."""
    l = numbered_lines(texts, key).where("in_code")
    fence = F.col("line").rlike(r"^\s*(```|~~~)")
    w = Window.partitionBy(key).orderBy("line_no")
    x = l.withColumn("fence", fence).withColumn("lang", F.last(F.when(fence, F.lower(F.regexp_extract("line", r"^\s*(?:```|~~~)\s*([\w+-]*)", 1))),
        ignorenulls=True).over(w)).withColumn("next", F.lead("line").over(w))
    shell = F.col("lang").isin("bash", "sh", "shell", "zsh", "console") & ~F.col("fence")
    back = F.col("line").rlike(r"\\\s*$")
    defect = F.when(back & F.col("next").rlike(r"^\s*(```|~~~)"), "open-continuation").when(back & (F.trim("next") == ""),
        "broken-continuation").when(F.col("line").rlike(r"\s`$"), "wrong-continuation")
    return x.where(shell).select(key, "line_no", defect.alias("defect")).where("defect is not null")


#: Prose families: name and pattern (all built fresh; terms are data).
FAMILIES = [
    ("P1-filler", r"(?iU)\b(?:è importante notare che|vale la pena|in conclusione|it is important to note|it is worth noting|in today's world)\b"),
    ("P2-contrast", r"(?iU)\b(?:non solo\b[^.]{1,60}\bma anche|not only\b[^.]{1,60}\bbut also|non si tratta (?:solo )?di\b)"),
    ("P3-triple", r"(?iU)\b[\p{L}]{4,}, [\p{L}]{4,}(?:,)? (?:e|and) [\p{L}]{4,}\b"),
    ("P4-dash", rf"[{Y.DASHES}]"),
    ("P5-intensifier", r"(?i)\b(?:estremamente|incredibilmente|assolutamente|extremely|incredibly|absolutely)\b"),
]


def prose_findings(texts: DataFrame, families: list[str] | None = None, key: str = "path") -> DataFrame:
    """``key, line_no, family, n``: matches of each family in prose lines; ``families`` picks some."""
    rules = [(n, p) for n, p in FAMILIES if families is None or n.split("-")[0] in families or n in families]
    l = numbered_lines(texts, key).where("not in_code").withColumn("prose", F.regexp_replace("line", r"`[^`]*`", ""))
    per = F.array(*[F.struct(F.lit(n).alias("family"), F.size(F.regexp_extract_all("prose", F.lit(p), F.lit(0))).alias("n")) for n, p in rules])
    return l.select(key, "line_no", F.explode(per).alias("x")).select(key, "line_no", "x.family", "x.n").where("n > 0")


def placeholders(texts: DataFrame, template: DataFrame, key: str = "path") -> DataFrame:
    """``key, placeholder``: angle-bracket tokens of a text's prose that its template holds too. ``template``: ``text``, one row."""
    tokens = lambda c: F.array_distinct(F.regexp_extract_all(F.regexp_replace(c, r"(?s)```.*?(?:```|\z)|`[^`\n]*`", ""),
        F.lit(r"(<[^<>\s][^<>\n]*>)"), F.lit(1)))
    known = template.select(F.explode(tokens("text")).alias("placeholder")).distinct()
    return texts.select(key, F.explode(tokens("text")).alias("placeholder")).join(known, "placeholder", "left_semi").select(key, "placeholder")


def front_matter(texts: DataFrame, key: str = "path") -> DataFrame:
    """``key, name, value, items``: entries of a YAML front matter, quotes stripped.

    ``items`` holds a list's members, written in brackets or one a line after ``-``; ``value`` a scalar, a folded (``>``) block
    joined by blanks and a literal (``|``) one by line breaks. Nested maps are left out; a text without front matter gives no
    rows.
    """
    head = F.regexp_extract("text", r"(?s)\A\ufeff?---\s*\n(.*?)\n---\s*(?:\n|\z)", 1)
    entry = F.filter(F.split(head, r"\n(?=[\w-]+:)"), lambda e: e.rlike(r"(?s)^[\w-]+:"))
    e = texts.select(key, F.explode(entry).alias("e")).select(key, F.regexp_extract("e", r"^([\w-]+):", 1).alias("name"),
        F.regexp_extract("e", r"(?s)^[\w-]+:[ \t]*(.*)$", 1).alias("raw"))
    bare = lambda c: F.regexp_replace(T.strip(c), r"(?s)^([\"'])(.*)\1$", "$2")
    lines = F.filter(F.split("raw", "\n"), lambda l: F.trim(l) != "")
    block = F.transform(F.slice(F.split("raw", "\n"), 2, 10_000), T.strip)
    dashed = F.transform(F.filter(lines, lambda l: l.rlike(r"^\s*-\s")), lambda l: bare(F.regexp_replace(l, r"^\s*-\s+", "")))
    inline = F.transform(F.split(F.regexp_extract("raw", r"(?s)^\[(.*)\]\s*$", 1), ","), bare)
    is_inline, is_dashed = F.col("raw").rlike(r"(?s)^\[.*\]\s*$"), F.col("raw").rlike(r"(?s)^\s*\n?\s*-\s")
    items = F.when(is_inline, F.filter(inline, lambda x: x != "")).when(is_dashed, dashed)
    folded, literal = F.col("raw").rlike(r"^>[+-]?\s*\n"), F.col("raw").rlike(r"^\|[+-]?\s*\n")
    value = F.when(folded, T.strip(F.array_join(block, " "))).when(literal, T.strip(F.array_join(block, "\n"))).when(is_inline | is_dashed,
        None).otherwise(bare(F.split("raw", "\n")[0]))
    return e.select(key, "name", value.alias("value"), items.alias("items")).where("items is not null or value is not null")


def draft_blocks(texts: DataFrame, key: str = "path") -> DataFrame:
    """``key, line_no, kind, level, value``: headings and lines of a draft from its first heading of level 2 or below on, and
    footnote definitions anywhere.

    Indented lines right after a definition go on with it, joined by blanks; a blank line or one without indent ends it.
    """
    l = numbered_lines(texts, key).where("not in_code")
    note = F.regexp_extract("line", r"^\[\^([^\]]+)\]:\s*(.*)$", 1)
    head = F.regexp_extract("line", r"^(#{1,6})\s+\S", 1)
    order = Window.partitionBy(key).orderBy("line_no")
    goes_on = F.col("line").rlike(r"^(?: {2,}|\t)\S")
    # a run begins at each line that does not go on; a run that begins with a definition is the note
    runs = l.withColumn("note", note).withColumn("run", F.sum(F.when(goes_on, 0).otherwise(1)).over(order))
    starts = runs.withColumn("of_note", F.first("note").over(Window.partitionBy(key, "run").orderBy("line_no")) != "")
    started = F.sum(F.when(F.length(head) >= 2, 1).otherwise(0)).over(order) > 0
    kind = F.when(F.col("of_note"), "footnote").when(started & (head != ""), "heading").when(started & (F.trim("line") != ""), "text")
    value = F.when(F.col("note") != "", F.regexp_extract("line", r"^\[\^[^\]]+\]:\s*(.*)$",
        1)).otherwise(T.strip(F.regexp_replace("line", r"^#{1,6}\s+", "")))
    rows = starts.select(key, "line_no", "run", kind.alias("kind"), F.length(head).alias("level"), value.alias("value")).where("kind is not null")
    notes = rows.where("kind = 'footnote'").groupBy(key, "run").agg(F.min("line_no").alias("line_no"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "value"))), lambda x: x["value"]), " ").alias("value"))
    others = rows.where("kind <> 'footnote'").drop("run")
    return others.unionByName(notes.select(key, "line_no", F.lit("footnote").alias("kind"), F.lit(0).alias("level"), F.trim("value").alias("value")))


def orphan_footnotes(texts: DataFrame, key: str = "path") -> DataFrame:
    """``key, note, status``: footnotes referred to but ``undefined``, and defined but ``unused``."""
    l = numbered_lines(texts, key).where("not in_code")
    defined = l.select(key, F.regexp_extract("line", r"^\[\^([^\]]+)\]:", 1).alias("note")).where("note <> ''").distinct()
    used = l.select(key, F.explode(F.regexp_extract_all(F.regexp_replace("line", r"^\[\^[^\]]+\]:", ""), F.lit(r"\[\^([^\]]+)\]"), F.lit(1)))
        .alias("note")).distinct()
    return used.join(defined, [key, "note"], "left_anti").withColumn("status",
        F.lit("undefined")).unionByName(defined.join(used, [key, "note"], "left_anti").withColumn("status", F.lit("unused")))


def nav_rows(nav: list, skip: tuple[str, ...] = ("Home",)) -> list[tuple[str, int, int, str, str]]:
    """(domain, domain_ord, cap_ord, name, file) of a parsed navigation: direct leaves belong to the top name, each sub-section is
    a domain of its own, deeper ones are flattened."""
    out: list[tuple[str, int, int, str, str]] = []
    order: dict[str, int] = {}

    def leaves(items: list) -> list[tuple[str, str]]:
        found = []
        for x in items:
            for name, v in x.items():
                found += [(name, v)] if isinstance(v, str) else leaves(v)
        return found

    def add(domain: str, items: list[tuple[str, str]]) -> None:
        at = order.setdefault(domain, len(order))
        start = sum(1 for r in out if r[0] == domain)
        out.extend((domain, at, start + i, n, f) for i, (n, f) in enumerate(items))

    for entry in nav:
        for top, v in entry.items():
            if top in skip or isinstance(v, str):
                continue
            add(top, [(n, f) for x in v for n, f in x.items() if isinstance(f, str)])
            for x in v:
                for name, sub in x.items():
                    if not isinstance(sub, str):
                        add(name, leaves(sub))
    return out


def stalled(polls: DataFrame, still: int = 3) -> DataFrame:
    """``job, stalled_at``: the first poll that ends ``still`` polls in a row without progress. ``polls``: ``job, poll_no, done``."""
    w = Window.partitionBy("job").orderBy("poll_no")
    x = polls.withColumn("same", F.coalesce((F.col("done") == F.lag("done").over(w)).cast("int"), F.lit(0)))
    run = F.sum("same").over(w.rowsBetween(-(still - 1), 0))
    return x.withColumn("run", run).where(F.col("run") >= still).groupBy("job").agg(F.min("poll_no").alias("stalled_at"))


def growth_since(revisions: DataFrame, days: int) -> DataFrame:
    """``path, n_chars, growth``: size at the last revision, and against the latest one at least ``days`` older (0 where there was
    none). ``revisions``: ``path, at, n_chars``."""
    last = revisions.groupBy("path").agg(F.max("at").alias("now"), F.max_by("n_chars", "at").alias("n_chars"))
    old = revisions.join(last.select("path", "now"), "path").where(F.col("at") <= F.col("now") - F.make_dt_interval(F.lit(days)))
    was = old.groupBy("path").agg(F.max_by("n_chars", "at").alias("was"))
    return last.join(was, "path", "left").select("path", "n_chars", (F.col("n_chars") - F.coalesce("was", F.lit(0))).alias("growth"))
