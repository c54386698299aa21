"""Queries over the taxonomy, the gate, publishing, audits and prose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filanda.functions import text as T
from filanda.functions import typography as Y
from filanda.operators import audit as A
from filanda.operators import gate as G
from filanda.operators import publish as P
from filanda.operators import taxonomy as X
from filanda.operators.snapshots import normal_path, snapshot_changes, snapshot_order
from filanda.plans import patterns as R
from filanda.runtime import table

#: A small taxonomy: domain, its place, capability's place, name, overview, tasks, kept for hand-picked evidence.
PAGES = [
    ("infrastruttura", 1, 1, "backup", "backup archivio ripristino storage database virtualizzazione conclusioni",
        "Orvexa Rethalon misure premessa proposta", False),
    ("infrastruttura", 1, 2, "rete", "rete monitoraggio telefonia network monitoring cablaggio", "Ilverna Ombrelia requisiti architettura", False),
    ("sicurezza", 2, 1, "accessi", "sicurezza accessi endpoint directory security access", "Calvento Zantero Nuvantis misure rischi", False),
    ("sicurezza", 2, 2, "collaudi", "collaudi database archive storage", "conclusioni allegati dettaglio", False),
    ("governo", 3, 1, "licenze", "licenze contratti fatturazione licensing billing", "Talmira Quendor proposta allegati", False),
    ("governo", 3, 2, "formazione", "formazione presenze stampa printing", "Ximora Fendaro Prelora", True),
]
DOMAINS = [("infrastruttura", 1, ["rete", "storage", "backup", "infrastruttura"]), ("sicurezza", 2, ["sicurezza", "accessi", "rischi"]),
    ("governo", 3, ["licenze", "contratti", "proposta"])]


def _index(spark: SparkSession) -> DataFrame:
    return X.keyword_index(spark.createDataFrame(PAGES,
        "domain string, domain_ord int, cap_ord int, name string, overview string, tasks string, manual_only boolean"))


def _domains(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DOMAINS, "domain string, domain_ord int, keywords array<string>")


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nodes").distinct().where("label is not null")


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes(spark, sf_dir).select(F.col("id").alias("node_id"), T.class_tokens(F.concat_ws(" ", "label", "source_file")).alias("tokens"))
    return X.classify(nodes, _index(spark), _domains(spark))


def taxonomy_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of each capability, one row a keyword with its place."""
    return _index(spark).select("domain", "name", F.posexplode("keywords").alias("pos", "keyword"))


def classify_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each node's capability, score, margin over the runner-up, bucket and review flag."""
    return _classified(spark, sf_dir).select("node_id", "capability", "score", "bucket", "margin", "runner_up", "runner_up_score",
        F.array_join("matched", " ").alias("matched"), "needs_review")


def classified_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes by domain and bucket, with those to review."""
    return _classified(spark, sf_dir).groupBy("domain", "bucket").agg(F.count("*").alias("nodes"), F.count_if("needs_review").alias("to_review"))


def near_miss_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communities of near misses, as proposals for a capability or a domain."""
    return X.near_misses(_classified(spark, sf_dir), _nodes(spark, sf_dir).select(F.col("id").alias("node_id"), "community"), _domains(spark))


def diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The taxonomy diff by bucket and domain."""
    d = table(spark, sf_dir, "taxonomy_diff").distinct()
    return d.groupBy("bucket", "domain").agg(F.count("*").alias("n"), F.count_if("is_hyperedge").alias("hyperedges"),
        F.count_if(F.col("score") >= X.FIT).alias("strong"), F.round(F.max("score"), 3).alias("best"))


def anonymisation_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placeholders of companies, persons, mailboxes, addresses and hosts, by frequency."""
    e = table(spark, sf_dir, "entities").distinct().where("value is not null").withColumn("category",
        F.when(F.col("category") == "IP_ADDRESS", "IP_ADDR").otherwise(F.col("category")))
    return G.anonymisation_map(e.groupBy("category", "value").agg(F.sum(F.coalesce("cnt", F.lit(0))).alias("cnt"),
        F.min("entity_id").alias("first_id")))


def anonymised_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previews of the taxonomy diff with the map's originals replaced."""
    d = table(spark, sf_dir, "taxonomy_diff").distinct().where("text_preview is not null").select("diff_id", "text_preview")
    return G.anonymise(d, anonymisation_map(spark, sf_dir), "diff_id", "text_preview")


def gate_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row of the taxonomy diff, kept or dropped and why, and its scrubbed preview."""
    return G.gate(table(spark, sf_dir, "taxonomy_diff").distinct()).select("diff_id", "kept", "reason", "text_preview",
        F.array_join("scrubbed", " ").alias("scrubbed"))


def gate_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept and dropped by bucket and reason."""
    return G.gate_statistics(G.gate(table(spark, sf_dir, "taxonomy_diff").distinct()))


def _fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "taxonomy_diff").distinct().where("bucket = 'fit' and node_id is not null and capability is not null")
    files = _nodes(spark, sf_dir).groupBy(F.col("id").alias("node_id")).agg(F.min("source_file").alias("source_file"))
    one = d.groupBy("node_id", F.col("capability").alias("page")).agg(F.min_by(F.struct("label", "text_preview", "community_id"),
        "diff_id").alias("x"))
    return one.select("node_id", "page", "x.label", F.col("x.text_preview").alias("text_preview"),
        F.col("x.community_id").alias("community")).join(files, "node_id", "left")


def evidence_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The block of every placement, with its stable id."""
    return P.evidence(_fits(spark, sf_dir))


def published_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the evidence of the first half of the capabilities already there: what is injected, refreshed and skipped."""
    wanted = P.evidence(_fits(spark, sf_dir))
    empty = wanted.select("page").distinct().select("page", F.concat(F.lit("# "), "page",
        F.lit("\n\n## Overview\n\nText.\n\n## Evidence\n")).alias("markdown"))
    first = P.apply(P.parse_pages(empty), wanted.where(F.ascii(F.col("sid")) < F.ascii(F.lit("8"))))
    return P.upsert(P.parse_pages(first), wanted)


def stale_placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placements of known nodes that are no longer expected: those of score below 0.2 are withdrawn here."""
    fits = _fits(spark, sf_dir)
    anchors = P.evidence(fits).select("page", "sid", "node_id")
    keep = table(spark, sf_dir, "taxonomy_diff").where("bucket = 'fit' and score >= 0.2").select("node_id",
        F.col("capability").alias("page")).where("node_id is not null and page is not null").distinct()
    return P.stale(anchors, fits.select("node_id"), keep, anchors).select("page", "sid", "node_id", "reason",
        F.array_join("moved_to", ",").alias("moved_to"))


def leak_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets and residual identifiers in the documents' texts."""
    files = table(spark, sf_dir, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), "text")
    return A.leak_findings(files)


def history_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each content hash once, under the path it first came by."""
    b = table(spark, sf_dir, "doc_skeleton").where("error is null and file_hash is not null").select(F.unix_micros("arrived_at").alias("commit_no"),
        F.col("file_hash").alias("blob_sha"), F.col("relative_path").alias("path"), F.col("file_name").alias("text"))
    return A.history_blobs(b)


def registry_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document's declared state is worth, against its file's size and latest hash."""
    k = table(spark, sf_dir, "doc_skeleton").where("doc_id is not null")
    first = k.groupBy("doc_id").agg(F.min_by("file_hash", F.struct("arrived_at", "file_hash")).alias("hash"), F.max("file_name").alias("artifact"))
    items = first.join(table(spark, sf_dir, "documents").select("doc_id", "n_chars", "title"), "doc_id").select(F.col("doc_id").alias("id"),
        F.when(F.col("n_chars") > 0, "done").otherwise("skipped").alias("state"), "artifact", F.col("doc_id").alias("source"), "hash",
        F.col("title").alias("note"))
    artifacts = k.groupBy(F.col("file_name").alias("artifact")).agg(F.max("file_size_bytes").alias("n_bytes"))
    sources = k.where("error is null").groupBy(F.col("doc_id").alias("source")).agg(F.max_by("file_hash",
        F.struct("arrived_at", "file_hash")).alias("hash_now"))
    return A.registry_status(items, artifacts, sources, 20_000)


def text_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of texts against a cap for each and for all, and their growth over the counted size."""
    d = table(spark, sf_dir, "documents")
    files = d.select(F.col("doc_id").alias("path"), "text", (F.col("lang").isNull()).alias("conditional"))
    return A.text_budget(files, d.where("n_chars > 1000").select(F.col("doc_id").alias("path"), "n_chars"), 20_000, 1_000_000)


def incremental_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose latest hash differs from their first."""
    k = table(spark, sf_dir, "doc_skeleton").where("error is null and doc_id is not null").select(F.col("doc_id").alias("key"), "file_hash",
        "arrived_at")
    when = F.struct("arrived_at", "file_hash")
    return A.changed_files(k.groupBy("key").agg(F.max_by("file_hash", when).alias("file_hash")),
        k.groupBy("key").agg(F.min_by("file_hash", when).alias("file_hash")))


def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First states replaced by latest ones where they changed, of documents that have a text."""
    k = table(spark, sf_dir, "doc_skeleton").where("error is null and doc_id is not null").select(F.col("doc_id").alias("key"), "file_hash",
        "arrived_at")
    when = F.struct("arrived_at", "file_hash")
    first = k.groupBy("key").agg(F.min_by("file_hash", when).alias("file_hash"))
    return A.incremental_merge(first, incremental_changed(spark, sf_dir),
        table(spark, sf_dir, "documents").where("text <> ''").select(F.col("doc_id").alias("key")))


def snapshot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Added, removed, changed and unchanged paths of each snapshot but a folder's first."""
    states = table(spark, sf_dir, "ingest_state")
    c = snapshot_changes(states).groupBy("state_id").agg(*[F.count_if(F.col("change") == x).alias(x) for x in ("added", "removed", "changed")])
    held = F.size(F.array_distinct(F.filter(F.transform(F.map_keys("files"), normal_path), lambda k: k != "")))
    sizes = states.where("files is not null").groupBy("state_id").agg(F.max(held).alias("held"))
    later = snapshot_order(states).where("seq > 1").select("state_id").join(sizes, "state_id").join(c, "state_id", "left")
    n = {x: F.coalesce(F.col(x), F.lit(0)) for x in ("added", "removed", "changed")}
    return later.select("state_id", *[v.alias(k) for k, v in n.items()], (F.col("held") - n["added"] - n["changed"]).alias("unchanged"))


def doc_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by the type in their file name."""
    k = table(spark, sf_dir, "doc_skeleton").select("doc_id", "file_name").distinct()
    return k.groupBy(T.doc_type("file_name").alias("doc_type")).agg(F.count("*").alias("docs"))


def note_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front matter of each document's note: title, type, date and tags from its most frequent entities."""
    k = table(spark, sf_dir, "doc_skeleton").groupBy("doc_id").agg(F.max("file_name").alias("name"))
    e = table(spark, sf_dir, "entities").distinct().where("value is not null").groupBy("doc_id", "category",
        "value").agg(F.sum(F.coalesce("cnt", F.lit(0))).alias("cnt"))
    rank = F.row_number().over(Window.partitionBy("doc_id", "category").orderBy(F.desc("cnt"), "value"))
    top = e.where("category in ('COMPANY', 'PROJECT_CODE', 'DATE')").withColumn("r", rank).where("r <= 3")
    of = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col("category") == c, F.struct("r", "value")))),
        lambda x: x["value"])
    g = top.groupBy("doc_id").agg(of("COMPANY").alias("co"), of("PROJECT_CODE").alias("pr"), of("DATE").alias("da"))
    x = k.join(g, "doc_id", "left")
    none = F.array().cast("array<string>")
    tags = F.concat(F.array(F.concat(F.lit("type/"), T.doc_type("name"))),
        F.transform(F.coalesce("co", none), lambda v: F.concat(F.lit("company/"), T.slug(v))),
        F.transform(F.coalesce("pr", none), lambda v: F.concat(F.lit("project/"), T.slug(v))))
    date = F.coalesce(F.get(F.col("da"), F.lit(0)), F.lit(""))
    head = F.concat_ws("\n", F.lit("---"), F.concat(F.lit("title: "), T.yaml_scalar(T.file_stem("name"))), F.concat(F.lit("date: "), date),
        F.concat(F.lit("tags: ["), F.array_join(tags, ", "), F.lit("]")), F.lit("---"))
    return x.select("doc_id", head.alias("head"))


def plain_dashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section titles and previews with dashes, as hyphens."""
    s = table(spark, sf_dir, "sections").distinct().where("preview_start is not null")
    return s.where(F.length("preview_start") > 0).select("section_id", Y.plain_dashes("preview_start").alias("text"),
        Y.dash_count("preview_start").alias("dashes"))


def paragraph_uniformity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficient of variation of the paragraphs' words in each document."""
    p = table(spark, sf_dir, "sections").distinct().select("doc_id", F.explode("paragraphs").alias("p")).select("doc_id",
        T.word_count("p").alias("w"))
    return A.uniformity(p, "doc_id", "w")


def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of Markdown tables in paragraphs, with their cells; a table is a run of such lines."""
    lines = table(spark, sf_dir, "sections").distinct().select("section_id", F.posexplode("paragraphs").alias("para_no", "p")).select("section_id",
        "para_no", F.posexplode(F.split("p", "\n")).alias("line_no", "line")).where(Y.is_table_row("line"))
    run = F.col("line_no") - F.row_number().over(Window.partitionBy("section_id", "para_no").orderBy("line_no"))
    return lines.withColumn("run", run).groupBy("section_id", "para_no", "run").agg(F.count("*").alias("n_lines"),
        F.min(Y.cell_count("line")).alias("min_cells"), F.max(Y.cell_count("line")).alias("max_cells")).drop("run")


def anchored_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each node the passage of its document that speaks of its label."""
    files = table(spark, sf_dir, "doc_skeleton").where("relative_path is not null").groupBy(F.col("relative_path").alias("source_file")).agg(F
        .min("doc_id").alias("doc_id"))
    texts = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return _nodes(spark, sf_dir).select("id", "label", "source_file").join(files, "source_file").join(texts, "doc_id").select("id",
        T.anchored_preview(T.strip_head("text"), "label").alias("preview"))


def event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour and type: the batch twin of the windowed stream."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("hour"), "event_type").agg(F.count("*").alias("events"),
        F.round(F.sum("value"), 4).alias("value"))


QUERIES = {
    f.__name__: f
    for f in (
        taxonomy_index, classify_nodes, classified_domains, near_miss_communities, diff_summary, anonymisation_map, anonymised_previews,
            gate_decisions, gate_stats, evidence_blocks, published_pages, stale_placements,
        leak_findings, history_blobs, registry_status, text_budget, incremental_changed, incremental_merge, snapshot_status, doc_types, note_heads,
            plain_dashes, paragraph_uniformity, table_rows, anchored_previews, event_hours,
    )
}

_LIT = ", ".join("('{}', {}, {}, '{}', '{}', '{}', {})".format(*p[:6], str(p[6]).lower()) for p in PAGES)
_ISTOP, _CSTOP = R.INDEX_STOP, R.CLASS_STOP
_KW = f"""
with pg(domain, domain_ord, cap_ord, name, overview, tasks, manual_only) as (values {_LIT}),
tk as (select domain, domain_ord, cap_ord, name, unnest(list_transform(ls, lambda x, i: {{'k': x, 'p': i * 2 + side}})) as z from (
  select *, list_filter(regexp_extract_all(lower(overview), '[a-z][a-z0-9+#.]{{2,}}'), lambda t: t not in ({_ISTOP})) as ls, 0 as side from pg where not manual_only
  union all select *, list_filter(regexp_extract_all(lower(tasks), '[a-z][a-z0-9+#.]{{2,}}'), lambda t: t not in ({_ISTOP})), 1 from pg where not manual_only)),
kw as (select domain, domain_ord, cap_ord, name, z.k as keyword, row_number() over (partition by domain, name order by min(z.p)) - 1 as pos from tk group by domain, domain_ord, cap_ord, name, z.k)
"""


def _res(column: str) -> str:
    out = column
    for _, p in R.RESIDUE:
        out = f"regexp_replace({out}, '{p}', '[REDATTO]', 'g')"
    return out


def _case(column: str, rules: list[tuple[str, str]]) -> str:
    return "case " + " ".join(f"when regexp_matches({column}, '{p}') then '{n}'" for n, p in rules) + " end"


_GATE = f"""
with d as (select distinct * from taxonomy_diff),
g as (select *, coalesce({_case('label', R.SECRETS)}, {_case('text_preview', R.SECRETS)}, {_case('label', R.RESIDUE)}, case when coalesce(length(regexp_replace(regexp_replace(label, '\\[[A-Z_]+(?:_\\d+)?\\]', '', 'g'), '[^\\p{{L}}\\p{{N}}]', '', 'g')), 0) < 10 then 'label-too-short' end) as reason from d)
"""
_FITS = """
with d as (select node_id, capability as page, arg_min({'l': label, 't': text_preview, 'c': community_id}, diff_id) as x from (select distinct * from taxonomy_diff) where bucket = 'fit' and node_id is not null and capability is not null group by 1, 2),
n as (select id as node_id, min(source_file) as source_file from nodes where label is not null group by 1),
f as (select d.node_id, page, x.l as label, x.t as text_preview, x.c as community, source_file, sha256(d.node_id || '::' || regexp_replace(page, '\\.(it|es|en)$', ''))[1:12] as sid from d left join n using (node_id))
"""
_LISTED = "with k as (select doc_id as key, file_hash, arrived_at from doc_skeleton where error is null and doc_id is not null), a as (select key, arg_max(file_hash, (arrived_at, file_hash)) as h1, arg_min(file_hash, (arrived_at, file_hash)) as h0 from k group by 1)"
_TYPE = R.DOC_TYPE
_SLUG = "regexp_replace(regexp_replace(lower({}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_WC = r"coalesce(len(regexp_extract_all({}, '\S+')), 0)"
_RULES = [*R.SECRETS, *R.RESIDUE]

_CLASSIFIED = (
    _KW
    + f""", n as (select id as node_id, list_distinct(list_filter(regexp_extract_all(lower(concat_ws(' ', label, source_file)), '[a-z][a-z0-9+#.]{{2,}}'), lambda t: t not in ({_CSTOP}))) as tokens from (select distinct * from nodes) where label is not null),
t as (select node_id, len(tokens) as n, unnest(tokens) as k from n),
s as (select node_id, domain_ord, cap_ord, name, count(*)::double / any_value(n) as score, string_agg(k, ' ' order by k) as matched, count(*) as m from t join kw on keyword = k group by all),
r as (select *, row_number() over w as r, lead(score) over w as second, lead(name) over w as second_name from s window w as (partition by node_id order by score desc, domain_ord, cap_ord))
select n.node_id, name as capability, round(coalesce(score, 0), 3) as score, case when coalesce(score, 0) >= 0.15 then 'fit' when coalesce(score, 0) >= 0.01 then 'near' else 'unclassified' end as bucket,
  round(coalesce(score, 0) - coalesce(second, 0), 4) as margin, second_name as runner_up, round(coalesce(second, 0), 3) as runner_up_score, coalesce(matched, '') as matched,
  name is not null and (round(coalesce(score, 0) - coalesce(second, 0), 4) <= 0.05 or m <= 1) as needs_review
from n left join r on r.node_id = n.node_id and r = 1"""
)
_FOLD = f"""
with c as ({_CLASSIFIED}), {_KW.strip()[5:]},
n as (select id as node_id, list_distinct(list_filter(regexp_extract_all(lower(concat_ws(' ', label, source_file)), '[a-z][a-z0-9+#.]{{2,}}'), lambda t: t not in ({_CSTOP}))) as tokens
  from (select distinct * from nodes) where label is not null),
t as (select node_id, len(tokens) as n, unnest(tokens) as k from n),
s as (select node_id, domain, domain_ord, cap_ord, count(*)::double / any_value(n) as sc from t join kw on keyword = k group by all),
dk as (select * from (values ('infrastruttura', 1, 'rete'), ('infrastruttura', 1, 'storage'), ('infrastruttura', 1, 'backup'), ('infrastruttura', 1, 'infrastruttura'),
  ('sicurezza', 2, 'sicurezza'), ('sicurezza', 2, 'accessi'), ('sicurezza', 2, 'rischi'), ('governo', 3, 'licenze'), ('governo', 3, 'contratti'), ('governo', 3, 'proposta')) v(domain, domain_ord, k)),
d as (select node_id, domain, domain_ord, -1 as cap_ord, count(*)::double / any_value(n) as sc from t join dk using (k) group by all),
r as (select * from d qualify sc > coalesce(max(sc) over (partition by node_id order by domain_ord rows between unbounded preceding and 1 preceding), 0)),
u as (select * from s qualify sc > coalesce(max(sc) over (partition by node_id order by domain_ord, cap_ord rows between unbounded preceding and 1 preceding), 0)),
e as (select * from r union all select * from u where (node_id, domain_ord) not in (select (node_id, domain_ord) from d)),
l as (select node_id, arg_max(domain, domain_ord * 1000 + cap_ord) as domain from e group by 1)
"""
_STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_ANON = """
with e as (select case when category = 'IP_ADDRESS' then 'IP_ADDR' else category end as category, value, sum(coalesce(cnt, 0)) as cnt, min(entity_id) as first_id from (select distinct * from entities) where value is not null group by 1, 2),
k as (select *, list_position(['COMPANY', 'PROPER_NOUN', 'EMAIL', 'IP_ADDR', 'HOSTNAME'], category) as prio from e where category in ('COMPANY', 'PROPER_NOUN', 'EMAIL', 'IP_ADDR', 'HOSTNAME')),
f as (select * from k qualify row_number() over (partition by value order by prio) = 1)
select value as original, category, '[' || ['AZIENDA', 'PERSONA', 'EMAIL', 'IP', 'HOSTNAME'][prio] || '_' || row_number() over (partition by category order by cnt desc, first_id, value) || ']' as placeholder from f"""
ORACLES = {
    "taxonomy_index": _KW + "select domain, name, pos, keyword from kw where pos < 90",
    "classify_nodes": _CLASSIFIED,
    "classified_domains": _FOLD + " select domain, bucket, count(*) as nodes, count_if(needs_review) as to_review from c left join l using (node_id) group by 1, 2",
    "near_miss_communities": _FOLD + """,
m as (select community, l.domain, score, tokens from c join l using (node_id) join n using (node_id) join (select id as node_id, community from (select distinct * from nodes) where label is not null) using (node_id) where bucket = 'near'),
w as (select community, arg_min(domain, (-v, domain)) as domain from (select community, domain, count(*) as v from m group by 1, 2) group by 1),
z as (select community, list_distinct(flatten(list(tokens))) as ts, count(*) as nodes, round(avg(score), 4) as mean_score from m group by 1),
y as (select z.*, w.domain, coalesce((select count(*) from dk where dk.domain = w.domain and list_contains(z.ts, dk.k)), 0)::double / len(ts) as rec from z join w using (community))
select community, domain, nodes, mean_score, round(rec, 4) as domain_recall, case when rec >= 0.08 then 'new_capability' else 'new_domain' end as proposal from y""",
    "diff_summary": "select bucket, domain, count(*) as n, count_if(is_hyperedge) as hyperedges, count_if(score >= 0.15) as strong, round(max(score), 3) as best from (select distinct * from taxonomy_diff) group by 1, 2",
    "anonymisation_map": _ANON,
    "anonymised_previews": f"""
with m as ({_ANON}),
d as (select distinct diff_id, text_preview as t from taxonomy_diff where text_preview is not null),
h as (select diff_id, list(original || chr(1) || placeholder order by -length(original), original) as ps from d join m on original <> '' and contains(t, original) group by 1)
select diff_id, case when ps is null then t else list_reduce(list_concat([t], ps), lambda acc, x: replace(acc, split_part(x, chr(1), 1), split_part(x, chr(1), 2))) end as text_preview from d left join h using (diff_id)""",
    "plain_dashes": """
select section_id, regexp_replace(preview_start, '[‒–—―−]', '-', 'g') as text, len(regexp_extract_all(preview_start, '[‒–—―−]')) as dashes from (select distinct * from sections) where length(preview_start) > 0""",
    "gate_decisions": _GATE + f"select diff_id, reason is null as kept, reason, {_res('text_preview')} as text_preview, "
        + "array_to_string(list_filter([" + ", ".join(f"case when regexp_matches(text_preview, '{p}') then '{n}' end" for n, p in R.RESIDUE)
        + "], lambda x: x is not null), ' ') as scrubbed from g",
    "gate_stats": _GATE + "select bucket, reason, count(*) as n from g group by 1, 2",
    "evidence_blocks": _FITS + r""", b as (select *, trim(regexp_replace(coalesce(text_preview, ''), '(?m)^[ \t]*#{1,6}[ \t]+', '', 'g')) as t from f)
select page, sid, node_id, coalesce(nullif(trim(regexp_replace(replace(regexp_replace(label, '^\s*#{1,6}\s*', ''), '#', ''), '\s+', ' ', 'g')), ''), node_id) as title,
  '<!-- id:' || sid || ' -->' || chr(10) || 'Source: ' || coalesce(source_file, '-') || ' · community ' || coalesce(community::varchar, '-') || chr(10) || chr(10) ||
  case when t = '' then '_No evidence yet._' when length(t) > 300 then t[1:300] || '…' else t end as body from b""",
    "published_pages": _FITS + "select page, sid, case when ascii(sid) < ascii('8') then 'skip' else 'inject' end as action from f",
    "stale_placements": _FITS
        + """, k as (select distinct node_id, capability as page from taxonomy_diff where bucket = 'fit' and score >= 0.2 and node_id is not null and capability is not null),
m as (select node_id, string_agg(page, ',' order by page) as moved from k group by 1)
select page, sid, node_id, case when moved is null then 'withdrawn' else 'moved' end as reason, coalesce(moved, '') as moved_to from f left join m using (node_id) where (node_id, page) not in (select (node_id, page) from k)""",
    "leak_findings": " union "
        .join("select doc_id || '.md' as path, '{}' as category, unnest(list_transform(regexp_extract_all(text, '{}'), lambda v: v[1:80])) as value from documents".format(n, p) for n, p in _RULES),
    "history_blobs": "select file_hash as blob_sha, arg_min({'p': relative_path, 'n': file_name}, (arrived_at, relative_path)).p as path, arg_min({'p': relative_path, 'n': file_name}, (arrived_at, relative_path)).n as text from doc_skeleton where error is null and file_hash is not null group by 1",
    "registry_status": """
with k as (select * from doc_skeleton where doc_id is not null),
f as (select doc_id, arg_min_null(file_hash, (arrived_at, file_hash)) as hash, max(file_name) as artifact from k group by 1),
a as (select file_name as artifact, max(file_size_bytes) as n_bytes from k group by 1),
s as (select doc_id, arg_max_null(file_hash, (arrived_at, file_hash)) as hash_now from k where error is null group by 1),
i as (select f.doc_id as id, case when n_chars > 0 then 'done' else 'skipped' end as state, f.*, title from f join documents using (doc_id))
select id, state, case when state = 'done' and n_bytes is null then 'artifact-missing' when state = 'done' and n_bytes < 20000 then 'artifact-too-small' when state = 'done' and hash_now is null then 'source-unverifiable'
  when state = 'done' and hash_now <> hash then 'source-changed' when state = 'skipped' and coalesce(trim(title), '') = '' then 'skipped-without-note' when state = 'done' then 'verified' else 'open' end as verdict
from i left join a using (artifact) left join s on s.doc_id = i.id""",
    "text_budget": "select doc_id as path, coalesce(length(text), 0) as n_chars, coalesce(length(text), 0) - case when n_chars > 1000 then n_chars else 0 end as growth, coalesce(length(text), 0) > 20000 as over_file, (select sum(length(text)) from documents where lang is not null) > 1000000 as over_total from documents",
    "incremental_changed": _LISTED + " select key, h1 as file_hash from a where h1 is distinct from h0",
    "incremental_merge": _LISTED + " select key, h1 as file_hash from a where key in (select doc_id from documents where text <> '')",
    "snapshot_status": r"""
with u as (select folder_key, try_cast(last_ingest_at as timestamptz) as inst, state_id, files from ingest_state where files is not null and folder_key is not null and try_cast(last_ingest_at as timestamptz) is not null),
one as (select folder_key, inst, arg_min(files, state_id) as files, min(state_id) as state_id from u group by 1, 2),
m as (select *, list_transform(map_keys(files), lambda k: regexp_replace(replace(k, '\', '/'), '^(\./+)+', '')) as ks, list_transform(map_values(files), lambda v: coalesce(lower(trim(v.sha256)), '?')) as vs from one),
p as (select *, list_transform(list_zip(ks, vs), lambda z: z[1] || chr(9) || z[2]) as rows from m),
l as (select state_id, ks, rows, lag(ks) over w as ks0, lag(rows) over w as rows0 from p window w as (partition by folder_key order by inst)),
c as (select state_id, len(list_filter(list_distinct(ks), lambda k: not list_contains(ks0, k))) as added, len(list_filter(list_distinct(ks0), lambda k: not list_contains(ks, k))) as removed,
  len(list_filter(list_distinct(rows), lambda r: not list_contains(rows0, r) and list_contains(ks0, split_part(r, chr(9), 1)))) as changed, len(list_distinct(ks)) as held from l where ks0 is not null)
select state_id, added, removed, changed, held - added - changed as unchanged from c""",
    "doc_types": f"select {_TYPE.format('lower(file_name)')} as doc_type, count(*) as docs from (select distinct doc_id, file_name from doc_skeleton) group by 1",
    "note_heads": rf"""
with k as (select doc_id, max(file_name) as name from doc_skeleton group by 1),
e as (select doc_id, category, value, sum(coalesce(cnt, 0)) as cnt from (select distinct * from entities) where value is not null and category in ('COMPANY', 'PROJECT_CODE', 'DATE') group by all),
r as (select *, row_number() over (partition by doc_id, category order by cnt desc, value) as r from e qualify r <= 3),
g as (select doc_id, list('company/' || {_SLUG.format('value')} order by r) filter (where category = 'COMPANY') as co, list('project/' || {_SLUG.format('value')} order by r) filter (where category = 'PROJECT_CODE') as pr, arg_min(value, r) filter (where category = 'DATE') as da from r group by 1),
x as (select k.*, regexp_replace(name, '(.)\.[^.]*$', '\1') as stem, co, pr, da from k left join g using (doc_id))
select doc_id, '---' || chr(10) || 'title: ' || case when regexp_matches(stem, '[:#\[\]{{}}",&*!|>''%@`]') then '"' || replace(stem, '"', '\"') || '"' else stem end || chr(10) || 'date: ' || coalesce(da, '') || chr(10) || 'tags: [' ||
  array_to_string(['type/' || {_TYPE.format('lower(name)')}] || coalesce(co, []) || coalesce(pr, []), ', ') || ']' || chr(10) || '---' as head from x""",
    "paragraph_uniformity": f"select doc_id, count(*) as n, case when count(*) >= 2 and avg(w) <> 0 then round(stddev_pop(w) / avg(w), 6) end as cv from (select doc_id, {_WC.format('p')} as w from (select doc_id, unnest(paragraphs) as p from (select distinct * from sections))) group by 1",
    "table_rows": r"""
with p as (select section_id, generate_subscripts(paragraphs, 1) - 1 as para_no, unnest(paragraphs) as p from (select distinct * from sections)),
l as (select section_id, para_no, generate_subscripts(ls, 1) as line_no, unnest(ls) as line from (select *, string_split(p, chr(10)) as ls from p)),
t as (select *, line_no - row_number() over (partition by section_id, para_no order by line_no) as run, len(string_split(regexp_replace(regexp_replace(trim(line), '\\\|', '', 'g'), '^\||\|$', '', 'g'), '|')) as cells from l where regexp_matches(trim(line), '^\|.*\|$'))
select section_id, para_no, count(*) as n_lines, min(cells) as min_cells, max(cells) as max_cells from t group by section_id, para_no, run""",
    "anchored_previews": rf"""
with n as (select distinct id, label, source_file from (select distinct * from nodes) where label is not null),
f as (select relative_path as source_file, min(doc_id) as doc_id from doc_skeleton where relative_path is not null group by 1),
t as (select doc_id, replace(text, chr(10), chr(10) || chr(10)) as t0 from documents),
a as (select doc_id, regexp_replace(regexp_replace(t0, '(?s)\A\s*<!--.*?-->\s*\n', ''), '(?s)\A\s*---\s*\n.*?\n---\s*\n', '') as t1 from t),
b as (select doc_id, regexp_replace(regexp_replace(t1, '\A[\s\p{{Z}}]+', ''), '\A(?:\s*#{{1,6}}[^\n]*\n+)+', '') as body from a),
j as (select id, body, list_distinct(list_filter(list_transform(regexp_extract_all(label, '[A-Za-zÀ-ÿ0-9]{{4,}}'), lambda x: lower(x)), lambda x: x not in ({R.PREVIEW_STOP}))) as ks,
  list_filter(list_transform(regexp_split_to_array(body, '\n\s*\n'), lambda x: {_STRIP.format('x')}), lambda x: x <> '') as ps from n join f using (source_file) join b using (doc_id)),
c as (select *, list_transform(ps, lambda p: len(list_filter(ks, lambda k: contains(lower(p), k)))) as sc from j),
e as (select id, body, ps, case when list_max(sc) > 0 then list_position(sc, list_max(sc)) end as pos from c)
select id, {_STRIP.format("(case when len(ps) = 0 then body when pos is null then array_to_string(ps, ' ') else array_to_string(ps[pos:pos + 2], ' ') end)[1:200]")} as preview from e""",
    "event_hours": "select date_trunc('hour', ts) as hour, event_type, count(*) as events, round(sum(value), 4) as value from events group by 1, 2",
}
