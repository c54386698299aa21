"""Office documents (``.docx``) as tables of blocks, sections and counts, read with the standard library inside Arrow batches."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filanda.functions import text as T

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
BLOCKS = "doc_id string, ord int, kind string, style string, text string, cells array<array<string>>, has_drawing boolean, error string"


def _text(node: ET.Element) -> str:
    out = []
    for x in node.iter():
        if x.tag == _W + "t":
            out.append(x.text or "")
        elif x.tag == _W + "tab":
            out.append("\t")
        elif x.tag in (_W + "br", _W + "cr"):
            out.append("\n")
    return "".join(out)


def blocks_of(content: bytes) -> Iterator[tuple[str, str | None, str, list | None, bool]]:
    """(kind, style, text, cells, has_drawing) of paragraphs and tables in their order."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ET.fromstring(z.read("word/document.xml")).find(_W + "body")
        names = {}
        if "word/styles.xml" in z.namelist():
            for s in ET.fromstring(z.read("word/styles.xml")).iter(_W + "style"):
                name = s.find(_W + "name")
                names[s.get(_W + "styleId")] = name.get(_W + "val") if name is not None else None
    for x in body if body is not None else ():
        drawing = any(y.tag in (_W + "drawing", _W + "pict") for y in x.iter())
        if x.tag == _W + "p":
            style = x.find(f"{_W}pPr/{_W}pStyle")
            ident = style.get(_W + "val") if style is not None else None
            yield "p", names.get(ident) or ident, _text(x), None, drawing
        elif x.tag == _W + "tbl":
            yield "tbl", None, "", [["\n".join(_text(p) for p in c.iter(_W + "p")) for c in r.findall(_W + "tc")] for r in x.findall(_W
                + "tr")], drawing


def read_blocks(files: DataFrame) -> DataFrame:
    """Blocks of each file; ``files``: ``rel, content``. A file that is no document gives one row with ``error``."""

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = []
            for rel, content in zip(p["rel"], p["content"], strict=True):
                try:
                    rows += [(rel, i, *b, None) for i, b in enumerate(blocks_of(content))] or [(rel, 0, "p", None, "", None, False, None)]
                except Exception as e:  # noqa: BLE001
                    rows.append((rel, 0, "p", None, "", None, False, type(e).__name__))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCKS.split(", ")])

    return files.select("rel", "content").mapInPandas(parse, BLOCKS)


def table_rows(cells: T.C):
    """Rows of a table as maps by the header row: blank headers ``col_i``, short rows padded, surplus cells dropped, of equal
    headers the last counts; a table of a header only is empty."""
    c = T.col(cells)
    head = F.transform(c[0], lambda h, i: F.when(T.strip(h) == "", F.concat(F.lit("col_"), i.cast("string"))).otherwise(T.strip(h)))

    def row(r):
        values = F.transform(head, lambda h, i: F.coalesce(F.get(r, i), F.lit("")))
        last = F.filter(F.transform(head, lambda h, i: F.when(F.size(F.filter(F.slice(head, i + 2, F.size(head) + 1), lambda x: x == h)) == 0,
            F.struct(h.alias("k"), F.get(values, i).alias("v")))), lambda x: x.isNotNull())
        return F.map_from_entries(last)

    return F.when(F.size(c) > 1, F.transform(F.slice(c, 2, F.size(c)), row)).otherwise(F.array())


def sections(blocks: DataFrame) -> DataFrame:
    """``doc_id, ord, level, title, word_count, char_count, preview_start, preview_end, tables_count, paragraphs``.

    A paragraph with a heading style, or beginning with a number, opens a section; what stands before the first is a section of
    level 0. Sections without paragraph and table are dropped, unless the document would have none.
    """
    b = blocks.where("error is null").where((F.col("kind") == "tbl") | (T.strip("text") != ""))
    styled = T.heading_level("style")
    level = F.when(F.col("kind") == "p", F.coalesce(styled, T.numbered_level("text")))
    title = F.when(styled.isNotNull(), T.strip("text")).otherwise(T.numbered_title("text"))
    w = Window.partitionBy("doc_id").orderBy("ord")
    x = b.withColumn("level", level).withColumn("title", F.when(level.isNotNull(), title)).withColumn("sec",
        F.sum(F.when(F.col("level").isNotNull(), 1).otherwise(0)).over(w))
    body = F.transform(F.array_sort(F.collect_list(F.when(F.col("level").isNull() & (F.col("kind") == "p"), F.struct("ord", "text")))),
        lambda p: p["text"])
    s = x.groupBy("doc_id", "sec").agg(F.coalesce(F.max("level"), F.lit(0)).alias("level"), F.max("title").alias("title"), body.alias("paragraphs"),
        F.count_if(F.col("kind") == "tbl").alias("tables_count"))
    s = s.withColumn("kept", (F.size("paragraphs") > 0) | (F.col("tables_count") > 0))
    any_kept = F.max("kept").over(Window.partitionBy("doc_id"))
    s = s.withColumn("any_kept", any_kept).where("kept or not any_kept")
    joined = F.array_join("paragraphs", "\n\n")
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy("sec")) - 1
    return s.select("doc_id", order.alias("ord"), "level", "title", T.word_count(joined).alias("word_count"), F.length(joined).alias("char_count"),
        T.preview_start(joined).alias("preview_start"), T.preview_end(joined).alias("preview_end"), "tables_count", "paragraphs")


def skeleton(blocks: DataFrame) -> DataFrame:
    """``doc_id, total_paragraphs, total_words, total_chars, estimated_tokens, tables_count, has_images, error``: one row a document."""
    p = (F.col("kind") == "p") & (T.strip("text") != "")
    per = blocks.groupBy("doc_id").agg(F.count_if(p).alias("total_paragraphs"), F.sum(F.when(p, F.length("text"))).alias("c"),
        F.count_if(F.col("kind") == "tbl").alias("tables_count"), F.max("has_drawing").alias("has_images"), F.max("error").alias("error"))
    s = sections(blocks).groupBy("doc_id").agg(F.sum("word_count").alias("total_words"), F.sum("char_count").alias("total_chars"))
    tokens = F.greatest(F.lit(1), F.floor((F.coalesce("c", F.lit(0)) + F.greatest(F.col("total_paragraphs") - 1, F.lit(0))) / 4))
    return per.join(s, "doc_id", "left").select("doc_id", "total_paragraphs", F.coalesce("total_words", F.lit(0)).alias("total_words"),
        F.coalesce("total_chars", F.lit(0)).alias("total_chars"), tokens.cast("bigint").alias("estimated_tokens"), "tables_count", "has_images",
        "error")


def to_markdown(section_table: DataFrame) -> DataFrame:
    """``doc_id, markdown``: headings one level deeper (at most 6), the untitled first section without heading, paragraphs parted by blank lines."""
    head = F.when(F.col("title").isNotNull(), F.concat(F.repeat(F.lit("#"), F.least(F.col("level") + 1, F.lit(6))), F.lit(" "), "title"))
    part = F.concat_ws("\n\n", head, F.array_join("paragraphs", "\n\n"))
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", part.alias("p")))), lambda x: x["p"]), "\n\n")
    return section_table.groupBy("doc_id").agg(F.concat(ordered, F.lit("\n")).alias("markdown"))


NOTES = "doc_id string, note_id string, text string"
MEDIA = "doc_id string, name string, content binary"


def notes_of(content: bytes) -> list[tuple[str, str]]:
    """(id, text) of a document's footnotes: paragraphs joined by blanks, separators and empty notes left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        if "word/footnotes.xml" not in z.namelist():
            return []
        root = ET.fromstring(z.read("word/footnotes.xml"))
    out = []
    for n in root.findall(_W + "footnote"):
        if n.get(_W + "type") not in ("separator", "continuationSeparator"):
            text = " ".join(t for t in ("".join(x.text or "" for x in p.iter(_W + "t")).strip() for p in n.iter(_W + "p")) if t)
            if text:
                out.append((n.get(_W + "id"), text))
    return out


def media_of(content: bytes) -> list[tuple[str, bytes]]:
    """(name, content) of the files that a document embeds."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return [(f.rsplit("/", 1)[-1], z.read(f)) for f in z.namelist() if f.startswith("word/media/") and not f.endswith("/")]


def _parts(files: DataFrame, read, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = []
            for rel, content in zip(p["rel"], p["content"], strict=True):
                try:
                    rows += [(rel, *x) for x in read(content)]
                except Exception:  # noqa: BLE001, S112
                    continue
            yield pd.DataFrame(rows, columns=names)

    return files.select("rel", "content").mapInPandas(parse, schema)


def read_footnotes(files: DataFrame) -> DataFrame:
    """``doc_id, note_id, text`` of each file's footnotes; ``files``: ``rel, content``. Files that are no documents give none;
    ``read_blocks`` says which they are."""
    return _parts(files, notes_of, NOTES)


def read_media(files: DataFrame) -> DataFrame:
    """``doc_id, name, content`` of the files embedded in each document."""
    return _parts(files, media_of, MEDIA)
