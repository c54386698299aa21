"""Queries that put files, folders, notes and labels of the tables through the operators on paths and Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filanda.functions import text as T
from filanda.functions import typography as Y
from filanda.operators import audit as A
from filanda.operators import lint as L
from filanda.plans import patterns, pipeline
from filanda.runtime import table
from filanda.sources import files as S


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "doc_skeleton").where("relative_path is not null").select(F.col("relative_path").alias("rel")).distinct()


def file_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files, a third of them renamed to telling names and to keys, by bucket."""
    h = F.length("rel") % 6
    named = F.when(h == 0, F.concat("rel", F.lit(".PEM"))).when(h == 1,
        F.concat(F.lit("x/Password "), F.replace("rel", F.lit("/"), F.lit("-")))).otherwise(F.col("rel"))
    return S.bucketed(_files(spark, sf_dir).select(named.alias("rel"))).groupBy("bucket").agg(F.count("*").alias("files"))


def globbed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files by globs: Word files at any depth, and those of one letter's names in a top folder."""
    return S.matching(_files(spark, sf_dir), ["**/*.docx", "*/R*"])


def kept_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files outside the excluded folders: those whose name has an even length."""
    f = _files(spark, sf_dir)
    folder = F.regexp_extract("rel", r"^(.*/)[^/]*$", 1)
    lines = f.select(folder.alias("d")).distinct().where("d <> '' and length(d) % 2 = 0").select(F.lit(1).alias("line_no"),
        F.concat("d", F.lit(" # pari")).alias("line"))
    return S.excluded(f, S.exclusion_rules(lines).where("error is null"))


def scope_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed paths outside those that nodes cite, and cited paths that are not listed."""
    cited = table(spark, sf_dir, "nodes").where("source_file is not null").select(F.col("source_file").alias("path")).distinct()
    return A.scope_check(cited, _files(spark, sf_dir).withColumnRenamed("rel", "path"))


def left_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previews that still hold a placeholder of the template."""
    t = table(spark, sf_dir, "sections").where("preview_start is not null").select(F.col("section_id").alias("path"),
        F.col("preview_start").alias("text")).distinct()
    return L.placeholders(t, spark.createDataFrame([("Per <NOME-CLIENTE>, <DATA> e <NOME>; `<codice>`",)], "text string"))


def label_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of node labels that can anchor a preview, by the nodes that have them."""
    n = table(spark, sf_dir, "nodes").distinct().where("label is not null")
    return n.select(F.explode(T.label_tokens("label")).alias("word")).groupBy("word").agg(F.count("*").alias("nodes"))


def heading_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections by the level of a heading style written from their own level, in several languages."""
    word = F.element_at(F.array(*[F.lit(x) for x in ("Heading ", "Titolo ", "heading", "Normal ")]), (F.col("section_id") % 4 + 1).cast("int"))
    s = table(spark, sf_dir, "sections").where("level is not null").select("section_id",
        F.concat(word, (F.col("level") * 3).cast("string")).alias("style")).distinct()
    return s.groupBy(T.heading_level("style").alias("level")).agg(F.count("*").alias("sections"))


def note_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front matter of the notes, read back: titles and dates, and the number of tags."""
    f = L.front_matter(pipeline.note_heads(spark, sf_dir).select(F.col("doc_id").alias("path"), F.concat("head", F.lit("\ntext")).alias("text")))
    return f.select(F.col("path").alias("doc_id"), "name", F.replace("value", F.lit('\\"'), F.lit('"')).alias("value"),
        F.size(F.coalesce("items", F.array())).alias("n_items"))


def restored_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files with byte order mark and carriage returns, read and written again."""
    bom, crlf = F.col("doc_id") % 2 == 0, F.col("doc_id") % 3 == 0
    d = table(spark, sf_dir, "documents").where("text is not null and not contains(text, chr(13))")
    raw = F.concat(F.when(bom, "﻿").otherwise(""), F.when(crlf, F.replace("text", F.lit("\n"), F.lit("\r\n")))
        .otherwise(F.col("text"))).cast("binary")
    read = d.select("doc_id", raw.alias("content")).select("doc_id", "content", S.decoded("content").alias("text"))
    back = S.restored("text", F.col("content").cast("string").startswith("﻿"), F.contains(F.col("content").cast("string"), F.lit("\r\n")))
    return read.select("doc_id", F.md5("text").alias("digest"), (back.cast("binary") == F.col("content")).alias("same"))


def restored_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without accents, and how many words get theirs back."""
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.translate("text", "àèéìòù", "aeeiou").alias("bare"))
    words = "|".join(w[:-1] + a for a, ws in Y.BARE.items() for w in ws)
    n = F.regexp_count(Y.missing_accents("bare"), F.lit(rf"(?iU)(?<![\w\-])(?:{words})(?![\w\-'’])"))
    return d.select("doc_id", n.alias("n")).where("n > 0")


QUERIES = {f.__name__: f for f in (file_buckets, globbed_files, kept_files, scope_check, left_placeholders, label_words, heading_styles, note_fields,
    restored_texts, restored_accents)}

_FILES = "select distinct relative_path as rel from doc_skeleton where relative_path is not null"
_BARE = patterns.quoted(
    "citta qualita densita verita attivita possibilita capacita identita integrita difficolta novita priorita volonta velocita modalita personalita proprieta quantita profondita conformita probabilita entita liberta "
    "fedelta comunita responsabilita ambiguita funzionalita facolta severita accessibilita parita rarita legalita opportunita impossibilita polarita plausibilita vulnerabilita operativita complessita reciprocita "
    "formalita fattibilita comodita realta affidabilita compatibilita disponibilita ammissibilita praticabilita specificita regolarita portabilita leggibilita tracciabilita immutabilita utilita curiosita generalita "
    "riproducibilita ispezionabilita verificabilita falsificabilita recuperabilita copiabilita replicabilita discontinuita continuita elettricita casualita ricorsivita involutivita ufficialita popolarita fragilita "
    "puntualita meccanicita particolarita retrocompatibilita indisponibilita commutativita gia cioe cosi puo piu giu virtu perche poiche benche affinche purche finche nonche anziche cosicche sicche dopodiche giacche fuorche"
)
#: A text without accents, and without code spans, addresses and paths.
_OPEN = r"regexp_replace(regexp_replace(regexp_replace(translate(text, 'àèéìòù', 'aeeiou'), '`+[^`\n]*`+', ' ', 'g'), '(?:https?://|ftp://|www\.)\S+', ' ', 'g'), '[\p{L}\p{N}_./\\-]*[/\\][\p{L}\p{N}_./\\-]+', ' ', 'g')"
ORACLES = {
    "file_buckets": f"select case when length(rel) % 6 = 0 then 'key-material' when length(rel) % 6 = 1 then 'sensitive-name' else 'ok' end as bucket, count(*) as files from ({_FILES}) group by 1",
    "globbed_files": f"select rel from ({_FILES}) where regexp_matches(rel, '\\.docx$') or regexp_matches(rel, '^[^/]*/R[^/]*$')",
    "kept_files": f"""
with f as ({_FILES}), h as (select rel, regexp_extract(rel, '^(.*/)[^/]*$', 1) as d from f), x as (select distinct d from h where d <> '' and length(d) % 2 = 0)
select rel from f where not exists (select 1 from x where starts_with(f.rel, x.d))""",
    "scope_check": f"""
with f as ({_FILES}), c as (select distinct source_file as path from nodes where source_file is not null)
select rel as path, 'outside' as status from f where rel not in (select path from c) union all select path, 'missing' from c where path not in (select rel from f)""",
    "left_placeholders": "select distinct section_id as path, p as placeholder from (select section_id, unnest(['<NOME-CLIENTE>', '<DATA>', '<NOME>']) as p, preview_start from sections where preview_start is not null) "
    "where contains(regexp_replace(preview_start, '`[^`\\n]*`', '', 'g'), p)",
    "label_words": "select word, count(*) as nodes from (select id, unnest(list_distinct(list_transform(regexp_extract_all(label, '[A-Za-zÀ-ÿ0-9]{4,}'), lambda x: lower(x)))) as word from (select distinct * from nodes) where label is not null) "
    "where word not in ("
        + patterns.quoted(
        "della delle degli dello dalla dalle nella nelle sono come questo questa quello quella essere anche with from that this have been were")
        + ") group by 1",
    "heading_styles": "select case when section_id % 4 = 3 then null else least(greatest(level * 3, 1), 6) end as level, count(distinct section_id) as sections from sections where level is not null group by 1",
    "note_fields": "with h as (" + pipeline.ORACLES["note_heads"] + r"""),
l as (select doc_id, string_split(head, chr(10)) as ls from h),
f as (select doc_id, 'title' as name, trim(ls[2][8:]) as v, 0 as n_items from l union all select doc_id, 'date', trim(ls[3][7:]), 0 from l)
select doc_id, name, replace(case when starts_with(v, '"') then v[2:-2] else v end, '\"', '"') as value, n_items from f
union all select doc_id, 'tags', null, len(string_split(ls[4], ', ')) from l""",
    "restored_texts": "select doc_id, md5(text) as digest, true as same from documents where text is not null and not contains(text, chr(13))",
    "restored_accents": rf"""
with t as (select doc_id, unnest(regexp_extract_all(lower({_OPEN}), '[\p{{L}}\p{{N}}\p{{M}}_\-''’]+')) as w from documents where text is not null),
k as (select doc_id, regexp_extract(w, '(?:^|[''’])([^''’]*)$', 1) as w from t)
select doc_id, count(*) as n from k where w in ({_BARE}) group by 1""",
}
