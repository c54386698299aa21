"""Queries over texts and sections: counts, previews, headings, hashes, entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filanda.functions import entities as E
from filanda.functions import text as T
from filanda.plans import patterns as R
from filanda.runtime import table


def _docs(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *more)


def doc_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, characters, estimated tokens and non-blank lines of each document."""
    lines = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.trim(x) != ""))
    return _docs(spark, sf_dir).select("doc_id", T.word_count("text").alias("n_words"), F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"),
        T.estimate_tokens("text").alias("est_tokens"), lines.alias("n_lines"))


def corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, words and estimated tokens of each language mark."""
    s = _docs(spark, sf_dir, "lang").select(F.lower(F.trim("lang")).alias("lang"), T.word_count("text").alias("w"),
        T.estimate_tokens("text").alias("t"))
    return s.groupBy("lang").agg(F.count("*").alias("document_count"), F.sum("w").alias("total_words"), F.sum("t").alias("total_estimated_tokens"))


def token_estimate_top30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thirty documents with the most estimated tokens."""
    return _docs(spark, sf_dir).select("doc_id", T.estimate_tokens("text").alias("est_tokens")).orderBy(F.desc("est_tokens"), "doc_id").limit(30)


def doc_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct text's hash, its first document and the number of its copies."""
    h = _docs(spark, sf_dir).where("text is not null").select("doc_id", F.substring(F.sha2("text", 256), 1, 16).alias("file_hash"))
    return h.groupBy("file_hash").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"))


def heading_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that begin with a number, by their depth."""
    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    found = lines.select("doc_id", "line_no", T.numbered_level("line").alias("level"), T.numbered_title("line").alias("title"))
    return found.where("level is not null")


def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines assigned to sections: a numbered heading opens one; sections without lines are dropped, unless the document would have none left."""
    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line")).where(T.strip("line") != "")
    head = T.numbered_level("line").isNotNull()
    placed = lines.withColumn("sec", F.sum(head.cast("int")).over(Window.partitionBy("doc_id").orderBy("n"))).withColumn("head", head)
    return placed.groupBy("doc_id", "sec").agg(F.max(F.when(F.col("head"), F.col("line"))).alias("title"),
        F.sum((~F.col("head")).cast("int")).alias("n_lines"), F.sum(F.when(~F.col("head"), T.word_count("line")).otherwise(0))
        .alias("n_words")).withColumn("most", F.max("n_lines").over(Window.partitionBy("doc_id"))).where("n_lines > 0 or most = 0").drop("most")


def section_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previews and counts of every section's full text."""
    s = table(spark, sf_dir, "sections").where("paragraphs is not null").select("section_id", F.array_join("paragraphs", "\n\n").alias("body"),
        "paragraphs").distinct()
    return s.select("section_id", T.preview_start("body").alias("start"), T.preview_end("body").alias("tail"), F.length("body").alias("n_chars"),
        T.word_count("body").alias("n_words"))


def section_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections by what was taken of them (previews, full text, both, neither), with their words."""
    s = table(spark, sf_dir, "sections").distinct()
    mode = F.when(F.col("paragraphs").isNull() & F.col("preview_start").isNull(), "skeleton").when(F.col("paragraphs").isNull(),
        "preview").when(F.col("preview_start").isNull(), "full").otherwise("both")
    return s.groupBy(mode.alias("mode"), "level").agg(F.count("*").alias("sections"), F.sum("word_count").alias("words"))


def section_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document the first section whose title contains a word, in any case."""
    s = table(spark, sf_dir, "sections").where(F.contains(F.lower("title"), F.lit("rischi")))
    return s.groupBy("doc_id").agg(F.min("ord").alias("ord"), F.min_by("title", F.struct("ord", "section_id")).alias("title"))


def _entity(category: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return E.extract(_docs(spark, sf_dir), [category]).select("doc_id", "value", "cnt")

    query.__doc__ = f"Distinct {category} entities of each document's text, counted."
    return query


def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of all twelve categories: occurrences, documents, rank; the fifty most frequent of each."""
    e = E.extract(_docs(spark, sf_dir))
    g = e.groupBy("category", "value").agg(F.sum("cnt").alias("cnt"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("cnt"), "value"))
    return g.withColumn("rnk", rank).where("rnk <= 50")


def _global(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "entities").distinct().where("value is not null")
    return e.groupBy("category", "value").agg(F.sum(F.coalesce("cnt", F.lit(0))).alias("cnt"), F.min("entity_id").alias("first_id"))


def global_top_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty most frequent values of each category over the corpus; equal counts by first appearance. Of companies the eighty
    most frequent are merged before the cut."""
    rank = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("cnt"), "first_id"))
    plain = _global(spark, sf_dir).where("category <> 'COMPANY'").select("category", "value", "cnt", rank.alias("rnk")).where("rnk <= 50")
    merged = _merged_companies(spark, sf_dir).select("value", "cnt",
        F.row_number().over(Window.orderBy(F.desc("cnt"), "first_rnk")).alias("rnk")).where("rnk <= 50")  # of eighty rows
    return plain.unionByName(merged.select(F.lit("COMPANY").alias("category"), "value", "cnt", "rnk"))


def _merged_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.row_number().over(Window.orderBy(F.desc("cnt"), "first_id"))
    top = _global(spark, sf_dir).where("category = 'COMPANY'").orderBy(F.desc("cnt"), "first_id").limit(80).withColumn("rnk", rank)
    return top.groupBy(T.col(E.company_key("value")).alias("company_key")).agg(F.max_by("value",
        F.struct(F.length("value"), -F.col("rnk"))).alias("value"), F.sum("cnt").alias("cnt"), F.min("rnk").alias("first_rnk"))


def company_alias_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eighty most frequent companies merged by name without legal form; the longest spelling stands for its group, the most
    frequent of equals."""
    return _merged_companies(spark, sf_dir).drop("first_rnk")


def entities_by_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts weighted by node: a document's entities count once for each node that cites its file."""
    nodes = table(spark, sf_dir, "nodes").distinct().where("source_file is not null").groupBy("source_file").agg(F.count("*").alias("n_nodes"))
    files = table(spark, sf_dir, "doc_skeleton").where("relative_path is not null").select(F.col("relative_path").alias("source_file"),
        "doc_id").distinct()
    cited = files.join(nodes, "source_file").groupBy("doc_id").agg(F.sum("n_nodes").alias("n_nodes"))
    e = table(spark, sf_dir, "entities").distinct().where("value is not null").groupBy("doc_id", "category",
        "value").agg(F.sum(F.coalesce("cnt", F.lit(0))).alias("cnt"))
    return e.join(cited, "doc_id").groupBy("category", "value").agg(F.sum(F.col("cnt") * F.col("n_nodes")).alias("weighted_cnt"))


QUERIES = {
    "doc_stats": doc_stats, "corpus_summary": corpus_summary, "token_estimate_top30": token_estimate_top30, "doc_hash_dedup": doc_hash_dedup,
        "heading_lines": heading_lines, "section_split": section_split,
    "section_previews": section_previews, "section_modes": section_modes, "section_lookup": section_lookup, "entity_counts": entity_counts,
        "global_top_entities": global_top_entities,
    "company_alias_merge": company_alias_merge, "entities_by_node": entities_by_node, **{f"entity_{c.lower()}": _entity(c) for c in E.EXTRACTORS},
}


def _matches(values: str) -> str:
    """SQL that counts the values a list expression gives for each document."""
    return f"select doc_id, value, count(*) as cnt from (select doc_id, unnest({values}) as value from documents where text is not null) group by all"


_STOP, _HOST_STOP, _BRAND = R.ACRONYM_STOP, R.HOST_STOP, R.HOST_BRANDS
_NUM = r"[\d.,]*\d[\d.,]*"
_AMT = " || ".join(
    f"list_transform(list_zip(regexp_extract_all(text, '{p}', 1, '{o}'), regexp_extract_all(text, '{p}', 2, '{o}')), lambda z: 'EUR ' || coalesce(nullif(z[1], ''), z[2]))"
    for p, o in ((rf"(?:euro|EUR)\s*({_NUM})|({_NUM})\s*(?:euro|EUR)", "i"), (rf"€\s*({_NUM})|({_NUM})\s*€", ""))
)
_ACR = f"list_filter(regexp_extract_all(text, '[A-Za-z]+'), lambda w: regexp_full_match(w, '[A-Z]{{2,7}}') and w not in ({_STOP}))"
_EMAIL = f"regexp_extract_all(text, '{R.EMAIL}', 1)"
_PROJ = f"regexp_extract_all(text, '{R.PROJECT}', 1)"
_WORDS = r"coalesce(len(regexp_extract_all(text, '\S+')), 0)"
_NUMBERED = r"^\s*(\d+(?:\.\d+){0,4})\.?\s+(\S.*)$"

ORACLES = {
    "doc_stats": rf"select doc_id, {_WORDS} as n_words, coalesce(length(text), 0) as n_chars, greatest(1, coalesce(length(text), 0) // 4) as est_tokens, len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x) <> '')) as n_lines from documents",
    "corpus_summary": f"select lower(trim(lang)) as lang, count(*) as document_count, sum({_WORDS}) as total_words, sum(greatest(1, coalesce(length(text), 0) // 4)) as total_estimated_tokens from documents group by 1",
    "token_estimate_top30": "select doc_id, greatest(1, coalesce(length(text), 0) // 4) as est_tokens from documents order by 2 desc, 1 limit 30",
    "doc_hash_dedup": "select sha256(text)[1:16] as file_hash, min(doc_id) as first_doc, count(*) as copies from documents where text is not null group by 1",
    "heading_lines": rf"""
with l as (select doc_id, generate_subscripts(ls, 1) - 1 as line_no, unnest(ls) as line from (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null))
select doc_id, line_no, len(string_split(regexp_extract(line, '{_NUMBERED}', 1), '.')) as level, regexp_extract(line, '{_NUMBERED}', 2) as title from l where regexp_matches(line, '{_NUMBERED}')""",
    "section_split": rf"""
with l as (select doc_id, generate_subscripts(ls, 1) as n, unnest(ls) as text from (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null)),
h as (select *, regexp_matches(text, '{_NUMBERED}') as head from l where regexp_replace(text, '[\s\p{{Z}}]+', '', 'g') <> ''),
p as (select *, sum(head::int) over (partition by doc_id order by n rows unbounded preceding) as sec from h)
select doc_id, sec, max(text) filter (where head) as title, sum((not head)::int) as n_lines, sum(case when head then 0 else {_WORDS} end) as n_words from p group by doc_id, sec qualify sum((not head)::int) > 0 or max(sum((not head)::int)) over (partition by doc_id) = 0""",
    "section_previews": rf"""
with s as (select distinct section_id, array_to_string(paragraphs, chr(10) || chr(10)) as text, paragraphs from sections where paragraphs is not null)
select section_id, regexp_replace(substr(text, 1, 200), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') as start, case when length(text) > 300 then regexp_replace(right(text, 100), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') else '' end as tail, length(text) as n_chars, {_WORDS} as n_words from s""",
    "section_modes": "select case when paragraphs is null and preview_start is null then 'skeleton' when paragraphs is null then 'preview' when preview_start is null then 'full' else 'both' end as mode, level, count(*) as sections, sum(word_count) as words from (select distinct * from sections) group by 1, 2",
    "section_lookup": "select doc_id, min(ord) as ord, arg_min(title, (ord, section_id)) as title from sections where contains(lower(title), 'rischi') group by 1",
    "entity_acronym": _matches(_ACR),
    "entity_project_code": _matches(_PROJ),
    "entity_email": _matches(_EMAIL),
    "entity_url": _matches(r"regexp_extract_all(text, '(https?://[^\s)\]]+|www\.[^\s)\]]+)')"),
    "entity_date": _matches(f"regexp_extract_all(text, '{R.DATE}', 1, 'i')"),
    "entity_amount": _matches(_AMT),
    "entity_law_ref": _matches(f"list_transform(regexp_extract_all(text, '{R.LAW}', 0, 'i'), lambda x: trim(x))"),
    "entity_doc_ref": _matches(f"list_transform(regexp_extract_all(text, '{R.DOC_REF}', 1, 'i'), lambda x: trim(x))"),
    "entity_company": _matches(
        f"list_transform(list_zip(regexp_extract_all(text, '{R.COMPANY}', 1), regexp_extract_all(text, '{R.COMPANY}', 2)), lambda z: z[1] || ' ' || z[2])"),
    "entity_ip_addr": r"""
with m as (select doc_id, unnest(list_zip(regexp_extract_all(text, '([0-9.]+)(/[0-9]{1,2})?([0-9.]*)', 1), regexp_extract_all(text, '([0-9.]+)(/[0-9]{1,2})?([0-9.]*)', 2), regexp_extract_all(text, '([0-9.]+)(/[0-9]{1,2})?([0-9.]*)', 3))) as z from documents where text is not null),
q as (select doc_id, z[1] as ip, case when coalesce(z[3], '') = '' then z[1] || coalesce(z[2], '') else z[1] end as value from m where regexp_full_match(z[1], '\d{1,3}(\.\d{1,3}){3}'))
select doc_id, value, count(*) as cnt from q where list_max(list_transform(string_split(ip, '.'), lambda o: o::int)) <= 255 group by all""",
    "entity_hostname": f"""
with c as (select doc_id, list_distinct(regexp_extract_all(text, '{R.HOST_PREFIX}', 1) || list_filter(regexp_extract_all(text, '{R.HOST_DASHED}', 1), lambda h: regexp_matches(h, '\\d') or len(h) - len(replace(h, '-', '')) >= 2)) as hs from documents where text is not null)
select doc_id, value, 1 as cnt from (select doc_id, unnest(hs) as value from c) where value not in ({_HOST_STOP}) and lower(value) not in ({_BRAND})""",
    "entity_proper_noun": f"""
with f as (select doc_id, list_distinct(flatten(list(regexp_split_to_array(n, '\\s+')))) as firm from (select doc_id, unnest(regexp_extract_all(text, '{R.COMPANY}', 1)) as n from documents) group by 1),
m as (select doc_id, trim(unnest(regexp_extract_all(text, '{R.PROPER}', 1))) as value from documents where text is not null),
t as (select doc_id, value, regexp_split_to_array(value, '\\s+') as ts from m where value <> '')
select doc_id, value, count(*) as cnt from t left join f using (doc_id) where ts[1] not in ({R.NAME_STOP}) and not list_has_any(ts, coalesce(firm, [])) and not list_has_any(ts, [{R.BRANDS}]) group by all""",
    "global_top_entities": rf"""
with g as (select category, value, sum(coalesce(cnt, 0)) as cnt, min(entity_id) as first_id from (select distinct * from entities) where value is not null group by all),
p as (select category, value, cnt, row_number() over (partition by category order by cnt desc, first_id) as rnk from g),
k as (select *, regexp_replace(lower(regexp_replace(value, '{R.LEGAL_END}', '', 'i')), '[^\p{{L}}\p{{N}}_]', '', 'g') as company_key from p where category = 'COMPANY' and rnk <= 80),
c as (select arg_max(value, (length(value), -rnk)) as value, sum(cnt) as cnt, min(rnk) as first_rnk from k group by company_key)
select category, value, cnt, rnk from p where category <> 'COMPANY' and rnk <= 50
union all select 'COMPANY', value, cnt, row_number() over (order by cnt desc, first_rnk) as rnk from c qualify rnk <= 50""",
    "company_alias_merge": rf"""
with g as (select value, sum(coalesce(cnt, 0)) as cnt, min(entity_id) as first_id from (select distinct * from entities) where value is not null and category = 'COMPANY' group by all),
t as (select *, row_number() over (order by cnt desc, first_id) as rnk from g qualify rnk <= 80),
k as (select *, regexp_replace(lower(regexp_replace(value, '{R.LEGAL_END}', '', 'i')), '[^\p{{L}}\p{{N}}_]', '', 'g') as company_key from t)
select company_key, arg_max(value, (length(value), -rnk)) as value, sum(cnt) as cnt from k group by 1""",
    "entities_by_node": """
with n as (select source_file, count(*) as n_nodes from (select distinct * from nodes) where source_file is not null group by 1),
f as (select distinct relative_path as source_file, doc_id from doc_skeleton where relative_path is not null),
c as (select doc_id, sum(n_nodes) as n_nodes from f join n using (source_file) group by 1),
e as (select doc_id, category, value, sum(coalesce(cnt, 0)) as cnt from (select distinct * from entities) where value is not null group by all)
select category, value, sum(cnt * n_nodes) as weighted_cnt from e join c using (doc_id) group by all""",
}

_ALL = " union all ".join(f"select '{c}' as category, doc_id, value, cnt from ({ORACLES[f'entity_{c.lower()}']})" for c in ("ACRONYM", "COMPANY",
    "LAW_REF", "PROJECT_CODE", "DATE", "AMOUNT", "EMAIL", "URL", "IP_ADDR", "HOSTNAME", "DOC_REF", "PROPER_NOUN"))
ORACLES["entity_counts"] = f"""
with g as (select category, value, sum(cnt) as cnt, count(*) as n_docs from ({_ALL}) group by 1, 2)
select * from (select *, row_number() over (partition by category order by cnt desc, value) as rnk from g) where rnk <= 50"""
