"""Queries over the registry, paths, generated files, collected text, gates over groups and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filanda.functions import text as T
from filanda.functions import typography as Y
from filanda.operators import audit as A
from filanda.operators import gate as G
from filanda.operators import notes as N
from filanda.operators import publish as P
from filanda.operators import registry as R
from filanda.plans import patterns, pipeline
from filanda.runtime import table


def _skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "doc_skeleton").distinct()


def _state():
    return F.when(F.col("error").isNotNull(), "error").when(F.col("file_hash").isNull(), "todo").when(F.col("has_images"),
        "doing").when(F.col("tables_count") > 0, "done").otherwise("skipped")


def registry_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings written as JSON lines, those of documents with images cut off, and read back: lines by state, malformed ones apart."""
    k = _skeleton(spark, sf_dir).where("doc_id is not null")
    line = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), _state().alias("state"), F.col("file_name").alias("artifact")))
    lines = k.select(F.when(F.col("has_images"), F.substring(line, 1, 20)).otherwise(F.concat(F.lit("﻿"), line)).alias("value"))
    return R.parse_lines(lines).groupBy("malformed", F.col("item.state").alias("state")).agg(F.count("*").alias("lines"))


def registry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the registry in all, by state, verified, left, discrepant, to be done again and not verifiable."""
    return R.state_counts(pipeline.registry_status(spark, sf_dir))


def next_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty listed documents that come next."""
    items = _skeleton(spark, sf_dir).where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.min(_state())
        .alias("state")).withColumn("agent", F.lit(None).cast("string"))
    return R.next_items(items, 20).select("id", "state")


def documents_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the order of their path."""
    return _skeleton(spark, sf_dir).where("relative_path is not null").select("relative_path", "doc_id").distinct().orderBy("relative_path", "doc_id")


def path_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed paths by their first folder."""
    return R.path_areas(_skeleton(spark, sf_dir).select(F.col("relative_path").alias("path")))


def listed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of the scans and of the nodes, and which list has them."""
    return R.listed_paths(_skeleton(spark, sf_dir).select(F.col("relative_path").alias("path")),
        table(spark, sf_dir, "nodes").select(F.col("source_file").alias("path")))


def wrapper_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the scans against those that nodes cite: what would be created, updated or is an orphan."""
    expected = table(spark, sf_dir, "nodes").where("source_file is not null").groupBy(F.col("source_file").alias("path")).agg(F.max("file_type")
        .alias("content"))
    k = _skeleton(spark, sf_dir).where("relative_path is not null").groupBy(F.col("relative_path").alias("path"))
    return R.wrapper_changes(expected, k.agg(F.max(F.regexp_extract("file_name", r"\.([^.]*)$", 1)).alias("content"),
        F.bool_or(F.coalesce("has_images", F.lit(False))).alias("generated")))


def sanitized_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stems of file names with a telling word put in, and neutral again."""
    k = _skeleton(spark, sf_dir).where("file_name is not null").select("file_name").distinct()
    stem = F.concat(F.lit("Passwords_"), F.regexp_replace("file_name", r"(?<=.)\.[^.]*$", ""), F.lit("-private_KEY token"))
    return k.select("file_name", R.sanitize_stem(stem).alias("stem"))


def sanitized_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as notes under a neutral name: length and digest, and what went wrong."""
    names = _skeleton(spark, sf_dir).groupBy("doc_id").agg(F.max("file_name").alias("name"))
    done = R.sanitized_markdown(table(spark, sf_dir, "documents").select("doc_id", "text").join(names, "doc_id"))
    return done.select("doc_id", "file_name", F.length("markdown").alias("n_chars"), F.md5("markdown").alias("digest"), "error")


def collected_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All text of each document's sections: length and digest."""
    done = R.collect_text(table(spark, sf_dir, "sections").select("doc_id", "section_id", "ord", "title", "preview_start", "preview_end",
        "paragraphs"))
    return done.select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


def findings_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct findings by category, the files they are in, and the grand total."""
    f = pipeline.leak_findings(spark, sf_dir)
    per = f.groupBy("category").agg(F.count("*").alias("findings"), F.countDistinct("path").alias("files"))
    return per.unionByName(f.agg(F.lit("total").alias("category"), F.count("*").alias("findings"), F.countDistinct("path").alias("files")))


def audit_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the texts may be published, and what forbids it."""
    f = pipeline.leak_findings(spark, sf_dir)
    secrets, residue = F.count_if(F.col("category").startswith("secret-")), F.count_if(F.col("category").startswith("residue-"))
    return f.agg(secrets.alias("secrets"), residue.alias("residues")).select("secrets", "residues", (F.col("secrets") == 0).alias("no_secrets"),
        (F.col("secrets") + F.col("residues") == 0).alias("passed"))


def scrub_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previews touched by each masking rule."""
    g = G.gate(table(spark, sf_dir, "taxonomy_diff").distinct())
    return g.select(F.explode("scrubbed").alias("rule")).groupBy("rule").agg(F.count("*").alias("fields"))


def gate_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to five rows of each bucket and reason of the gate."""
    g = G.gate(table(spark, sf_dir, "taxonomy_diff").distinct()).select("bucket", "reason", "diff_id", "label")
    return g.withColumn("r", F.row_number().over(Window.partitionBy("bucket", "reason").orderBy("diff_id"))).where("r <= 5")


def page_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capabilities as pages with an English and an Italian variant of every other one, and the evidence each variant gets."""
    wanted = P.evidence(pipeline._fits(spark, sf_dir)).select("page", "sid")
    base = wanted.select("page").distinct()
    pages = base.unionByName(base.where("length(page) % 2 = 0").select(F.concat("page", F.lit(".en")).alias("page"))).unionByName(base
        .where("length(page) % 3 = 0").select(F.concat("page", F.lit(".it")).alias("page")))
    return P.on_variants(wanted, pages).groupBy("page").agg(F.count("*").alias("blocks"))


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fits of the review report under their capability, and the names left unclassified."""
    c = pipeline._classified(spark, sf_dir)
    return N.report_parts(c, pipeline.near_miss_communities(spark, sf_dir)).where("part in ('1 summary', '5 unclassified')")


def gated_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals by community: the nodes that stay and those dropped."""
    d = table(spark, sf_dir,
        "taxonomy_diff").distinct().where("bucket in ('new_capability', 'new_domain') and community_id is not null and node_id is not null")
    return G.gate_groups(d.select(F.col("community_id").alias("group_id"), "node_id", "label", "text_preview"))


def structure_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged structure in texts as they are after masking, with a heading put before each text."""
    texts = table(spark, sf_dir, "sections").distinct().where("preview_start is not null")
    masked = G.scrub(F.concat(F.lit("# "), "preview_start"))
    return texts.select("section_id", F.explode(G.rules_found(masked, G.STRUCTURE)).alias("rule"))


def domain_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain names of third parties in the documents' texts, each with a line of such and of public names put before it."""
    rule = dict(G.domain_rules())["residue-domain-third-party"]
    line = F.concat(F.lit("Vedi Area."), F.coalesce("source", F.lit("altro")), F.lit("-portale.com, docs.github.com, x.aruba.it e user@posta.com. "))
    d = table(spark, sf_dir, "documents").where(F.contains("text", F.lit("."))).select("doc_id", F.concat(line, "text").alias("text"))
    return d.select("doc_id", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(rule), F.lit(0)), F.lower))).alias("domain"))


def person_token_scrub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previews that hold words of persons' names, and these words masked."""
    tokens = G.person_tokens(pipeline.anonymisation_map(spark, sf_dir))
    d = table(spark, sf_dir, "taxonomy_diff").distinct().where("text_preview is not null").select("diff_id", "text_preview")
    done = G.token_residue(d, tokens, "diff_id", "text_preview").where(F.size("tokens_found") > 0)
    return done.select("diff_id", F.array_join("tokens_found", " ").alias("tokens"), F.length("text_preview").alias("n_chars"))


def audit_person_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of persons' names that are no words of titles of sections."""
    titles = table(spark, sf_dir, "sections").where("title is not null").select(F.explode(F.regexp_extract_all("title", F.lit(r"([\p{L}]+)"),
        F.lit(1))).alias("word"))
    return G.audit_person_terms(pipeline.anonymisation_map(spark, sf_dir), titles, ["Marta"])


def keyword_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capabilities, average keywords and cut-off lists of each domain."""
    return pipeline._index(spark).groupBy("domain").agg(F.count("*").alias("capabilities"),
        F.round(F.avg(F.size("keywords")), 4).alias("mean_keywords"), F.count_if(F.col("keywords_dropped") > 0).alias("cut"))


def token_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thirty documents with the most estimated tokens, and one row for all others together."""
    t = table(spark, sf_dir, "documents").select("doc_id", T.estimate_tokens("text").alias("est_tokens"))
    top = t.orderBy(F.desc("est_tokens"), "doc_id").limit(30)
    shown = top.agg(F.sum("est_tokens").alias("n"), F.count("*").alias("c"))
    rest = t.agg(F.sum("est_tokens").alias("all_n"), F.count("*").alias("all_c")).crossJoin(F.broadcast(shown)).select(F.lit(None).cast("long")
        .alias("doc_id"), F.expr("all_n - n").alias("est_tokens"), F.expr("all_c - c").alias("docs"))
    return top.withColumn("docs", F.lit(1).cast("long")).unionByName(rest)


def new_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of proposed capabilities, whole."""
    d = table(spark, sf_dir, "taxonomy_diff").distinct().where("bucket = 'new_capability'")
    g = d.select(F.concat(F.lit("Community "), F.col("community_id").cast("string")).alias("name"), "domain", "label", "text_preview",
        F.col("diff_id").alias("ord"))
    return P.missing_pages(P.new_page(g), d.where("capability is not null").select(F.col("capability").alias("page")))


def published_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty pages after publishing, as Markdown."""
    wanted = P.evidence(pipeline._fits(spark, sf_dir))
    empty = wanted.select("page").distinct().select("page", F.concat(F.lit("# "), "page",
        F.lit("\n\n## Overview\n\nText.\n\n## Evidence\n")).alias("markdown"))
    return P.apply(P.parse_pages(empty), wanted).select("page", F.length("markdown").alias("n_chars"),
        F.size(F.split("markdown", "\n### ")).alias("parts"))


QUERIES = {
    f.__name__: f
    for f in (
        registry_lines, registry_counts, next_items, documents_by_path, path_areas, listed_paths, wrapper_changes, sanitized_stems, sanitized_notes,
            collected_text, findings_total, audit_gate, scrub_counts,
        gate_examples, page_variants, review_lines, gated_groups, structure_findings, domain_findings, person_token_scrub, audit_person_terms,
            keyword_averages, token_report, new_pages, published_markdown,
    )
}

_STATE = "case when error is not null then 'error' when file_hash is null then 'todo' when has_images then 'doing' when tables_count > 0 then 'done' else 'skipped' end"
_STEM = r"regexp_replace({}, '(.)\.[^.]*$', '\1')"
_NEUTRAL = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, 'private[_-]?keys?', 'chiave-privata', 'gi'), 'passwords?', 'autenticazione', 'gi'), 'passwd', 'autenticazione', 'gi'), 'credentials?', 'accesso', 'gi'), 'secrets?', 'riservato', 'gi'), 'tokens?', 'chiave', 'gi')"
_FOUND = pipeline.ORACLES["leak_findings"]
_PUBLIC = (
    "microsoft|microsoftonline|office|office365|azure|windows|live|sharepoint|google|gmail|googleapis|youtube|apple|amazon|amazonaws|cloudflare|github|ubuntu|canonical|redhat|suse|vmware|veeam|acronis|synology|qnap|zyxel|"
    "fortinet|sophos|cisco|ubnt|eset|kaspersky|malwarebytes|virustotal|nvidia|intel|amd|dell|hp|lenovo|openai|anthropic|bitdefender|myzyxel|supremocontrol|rws|sdl|atlassian|stackoverflow|docker|unpkg"
)
_PERSONS = """
with m as (select original from (""" + pipeline.ORACLES[
    "anonymisation_map"] + r""") where category = 'PROPER_NOUN' and regexp_full_match(original, '\p{Lu}\p{L}+ \p{Lu}\p{L}+')),
k as (select distinct token from (select unnest(string_split(original, ' ')) as token from m) where length(token) >= 4)
"""  # fmt: skip

ORACLES = {
    "registry_lines": f"select coalesce(has_images, false) as malformed, case when coalesce(has_images, false) then null else {_STATE} end as state, count(*) as lines from (select distinct * from doc_skeleton) where doc_id is not null group by 1, 2",
    "registry_counts": "select count(*) as items, count_if(state = 'todo') as todo, count_if(state = 'doing') as doing, count_if(state = 'done') as done, count_if(state = 'skipped') as skipped, count_if(state = 'error') as error, "
    "count_if(state is null or state not in ('todo', 'doing', 'done', 'skipped', 'error')) as unknown, count_if(verdict = 'verified') as verified, count_if(state not in ('done', 'skipped')) as left, "
    "count_if(verdict in ('artifact-missing', 'artifact-too-small', 'skipped-without-note')) as discrepant, count_if(verdict = 'source-changed') as again, count_if(verdict = 'source-unverifiable') as unverifiable from ("
    + pipeline.ORACLES["registry_status"] + ")",
    "next_items": f"select id, state from (select doc_id as id, min({_STATE}) as state from doc_skeleton where doc_id is not null group by 1) where state in ('todo', 'doing') order by id limit 20",
    "documents_by_path": "select distinct relative_path, doc_id from doc_skeleton where relative_path is not null",
    "path_areas": "with a as (select case when contains(p, '/') then split_part(p, '/', 1) else '(root)' end as area, count(*) as n_paths from (select distinct relative_path as p from doc_skeleton where relative_path is not null) group by 1) "
    "select area, n_paths, (select sum(n_paths) > 10 or count(*) > 1 from a) as confirm from a",
    "listed_paths": "with t as (select distinct relative_path as path from doc_skeleton where relative_path is not null), u as (select distinct source_file as path from nodes where source_file is not null) "
    "select coalesce(t.path, u.path) as path, t.path is not null as tracked, u.path is not null as untracked from t full join u on t.path = u.path",
    "wrapper_changes": r"""
with e as (select source_file as path, max(file_type) as want from nodes where source_file is not null group by 1),
p as (select relative_path as path, max(regexp_extract(file_name, '\.([^.]*)$', 1)) as have, bool_or(coalesce(has_images, false)) as gen from doc_skeleton where relative_path is not null group by 1),
j as (select coalesce(e.path, p.path) as path, case when p.path is null then 'create' when e.path is null and gen then 'orphan' when e.path is not null and want is distinct from have then 'update' end as action from e full join p on e.path = p.path)
select path, action from j where action is not null""",
    "sanitized_stems": "select distinct file_name, " + _NEUTRAL.format("'Passwords_' || " + _STEM.format("file_name") + " || '-private_KEY token'")
        + " as stem from doc_skeleton where file_name is not null",
    "sanitized_notes": f"""
with n as (select doc_id, max(file_name) as name from doc_skeleton group by 1),
c as (select doc_id, text, {_NEUTRAL.format(_STEM.format('name'))} as stem from documents join n using (doc_id)),
m as (select *, case when coalesce(trim(text), '') <> '' then '---' || chr(10) || 'source: ' || stem || chr(10) || '---' || chr(10) || chr(10) || '# ' || stem || chr(10) || chr(10) || text || chr(10) end as md from c)
select doc_id, stem || '.md' as file_name, length(md) as n_chars, md5(md) as digest, case when md is null then 'empty' when regexp_matches(stem, '(?i)private[_-]?key|password|passwd|credential|secret|token') then 'telling-name' end as error from m""",
    "collected_text": """
with s as (select distinct doc_id, section_id, ord, array_to_string(list_filter(list_concat([title, preview_start, preview_end], coalesce(paragraphs, [])), lambda x: x <> ''), chr(10)) as t from sections),
d as (select doc_id, coalesce(string_agg(t, chr(10) order by ord, section_id) filter (where t <> ''), '') as text from s group by 1)
select doc_id, length(text) as n_chars, md5(text) as digest from d""",
    "findings_total": f"with f as ({_FOUND}) select category, count(*) as findings, count(distinct path) as files from f group by 1 union all select 'total', count(*), count(distinct path) from f",
    "audit_gate": f"with f as ({_FOUND}), c as (select count_if(starts_with(category, 'secret-')) as secrets, count_if(starts_with(category, 'residue-')) as residues from f) select *, secrets = 0 as no_secrets, secrets + residues = 0 as passed from c",
    "gate_examples": pipeline._GATE
        + "select bucket, reason, diff_id, label, row_number() over (partition by bucket, reason order by diff_id) as r from g qualify r <= 5",
    "page_variants": pipeline._FITS
        + ", c as (select page, count(*) as blocks from f group by 1) select page, blocks from c union all select page || '.en', blocks from c where length(page) % 2 = 0 union all select page || '.it', blocks from c where length(page) % 3 = 0",
    "review_lines": f"with c as ({pipeline.ORACLES['classify_nodes']}) select '1 summary' as part, '' as head, row_number() over (order by bucket) as place, '| ' || bucket || ' | ' || count(*) || ' | ' || count_if(needs_review) || ' |' as line from c group by bucket "
    "union all select '5 unclassified', node_id[1:1], row_number() over (partition by node_id[1:1] order by node_id), '- ' || node_id from c where bucket = 'unclassified'",
    "scrub_counts": " union all "
        .join(f"select '{n}' as rule, count(*) as fields from (select distinct * from taxonomy_diff) where regexp_matches(text_preview, '{p}') having count(*) > 0" for n, p in patterns.RESIDUE),
    "gated_groups": f"""
with d as (select community_id as group_id, node_id, coalesce({pipeline._case('label', patterns.SECRETS)}, {pipeline._case('text_preview', patterns.SECRETS)}) is not null as secret, {pipeline._case('label', patterns.RESIDUE)} is not null as residue
  from (select distinct * from taxonomy_diff) where bucket in ('new_capability', 'new_domain') and community_id is not null and node_id is not null),
n as (select group_id, node_id, bool_or(secret) as secret, bool_or(residue) as residue from d group by 1, 2)
select group_id, node_id, not bool_or(secret) over (partition by group_id) and not residue as kept from n""",
    "structure_findings": f"""
with m as (select section_id, {pipeline._res("'# ' || preview_start")} as t from (select distinct * from sections) where preview_start is not null)
select section_id, 'structure-heading' as rule from m where regexp_matches(t, '(?im)^#{{1,6}}\\s+.*\\b(?:In data\\s+[0-9]|Please complete|si e'' scritto|e'' stato creato|In alternativa dal)')
union all select section_id, 'structure-partial-mask' from m where regexp_matches(t, '\\[(?:RIMOSSO|REDATTO)\\][a-z]{{2,}}')""",
    "domain_findings": rf"""
with t as (select doc_id, unnest(regexp_extract_all(lower('Vedi Area.' || coalesce(source, 'altro') || '-portale.com, docs.github.com, x.aruba.it e user@posta.com. ' || text), '[\p{{L}}\p{{N}}_@.\-]+')) as run from documents where contains(text, '.')),
d as (select doc_id, regexp_extract(run, '^((?:[a-z0-9](?:[a-z0-9\-]*[a-z0-9])?\.)+(?:cloud|info|tech|com|net|org|dev|app|biz|gov|edu|it|eu|io|ai|co|de|fr|es|uk|ch|at|nl|be|us|ca))(?:\.[^a-z0-9].*|\.)?$', 1) as domain from t)
select distinct doc_id, domain from d where domain <> '' and not regexp_matches(domain, '(^|\.)({_PUBLIC})\.com$')
  and not regexp_matches(domain, '(^|\.)(seeweb|seewebcloud|fastnet|aruba|arubabusiness|vianova|register|ovh|ionos|garanteprivacy|agid\.gov|acn\.gov)\.it$') and not regexp_matches(domain, '(^|\.)(github|java|readthedocs|kubernetes|system)\.io$')
  and not regexp_matches(domain, '(^|\.)(asp|vb|ado|system|java|microsoft|atlassian|jsdelivr)\.net$')
  and not regexp_matches(domain, '(^|\.)(python|pypi|mkdocs|dokuwiki|ubuntu-it|readthedocs|debian|kernel|gnu|apache|mozilla|letsencrypt|iso|w3|ietf|rfc-editor|wikipedia|bitbucket)\.org$')
  and not regexp_matches(domain, '(^|\.)(nist\.gov|cisa\.gov|europa\.eu|claude\.ai|gitlab\.com)$')""",
    "person_token_scrub": _PERSONS + r""",
d as (select distinct diff_id, text_preview as t from (select distinct * from taxonomy_diff) where text_preview is not null),
w as (select distinct diff_id, t, unnest(regexp_extract_all(t, '[\p{L}\p{N}\p{M}_]+')) as token from d),
h as (select diff_id, any_value(t) as t, list(token order by token) as ts from (select distinct diff_id, t, token from w join k using (token)) group by 1)
select diff_id, array_to_string(ts, ' ') as tokens, (length(t) + list_sum(list_transform(ts, lambda x: (9 - length(x)) * len(list_filter(regexp_extract_all(t, '[\p{L}\p{N}\p{M}_]+'), lambda y: y = x)))))::bigint as n_chars from h""",
    "audit_person_terms": _PERSONS + r""",
n as (select distinct lower(unnest(regexp_extract_all(title, '\p{L}+'))) as w from sections where title is not null)
select token from k where lower(token) not in (select w from n) and token <> 'Marta'""",
    "keyword_averages": pipeline._KW
        + ", c as (select p.domain, p.name, count(k.keyword) as n from pg p left join (select * from kw where pos < 90) k on k.domain = p.domain and k.name = p.name group by all) select domain, count(*) as capabilities, round(avg(n), 4) as mean_keywords, 0 as cut from c group by 1",
    "token_report": "with t as (select doc_id, greatest(1, coalesce(length(text), 0) // 4) as n, row_number() over (order by greatest(1, coalesce(length(text), 0) // 4) desc, doc_id) as r from documents) "
    "select doc_id, n as est_tokens, 1 as docs from t where r <= 30 union all select null, sum(n), count(*) from t where r > 30",
    "new_pages": r"""
with d as (select distinct * from taxonomy_diff where bucket = 'new_capability'),
g as (select 'Community ' || community_id as name, 'community-' || community_id as page, * from d where community_id is not null),
l as (select page, string_agg('- ' || label, chr(10) order by diff_id, label) as labels from (select *, row_number() over (partition by page order by diff_id, label) as r from g where label <> '') where r <= 10 group by 1),
o as (select page, min(name) as name, min(domain) as domain, arg_min(replace(text_preview[1:80], chr(10), ' '), diff_id) filter (where text_preview <> '') as preview from g group by 1),
x as (select *, chr(10) || chr(10) as nn from o left join l using (page))
select page, '# ' || name || nn || '## Overview' || nn || '*Capability proposed from documents.*' || chr(10) || 'Domain: **' || coalesce(domain, '-') || '**.' || coalesce(chr(10) || 'Preview: ' || preview, '') || nn || '## Technologies & tools' || nn || '_No evidence yet._' || nn ||
  '## Responsibilities & operational scope' || nn || coalesce(labels || nn, '') || '## Evidence' || nn || '_No evidence yet._' || chr(10) as markdown from x where page not in (select capability from d where capability is not null)""",
    "published_markdown": "with e as (" + pipeline.ORACLES["evidence_blocks"] + r"""),
b as (select page, sum(length('### ' || title || chr(10) || trim(body)) + 2) as n, count(*) as c from e group by 1)
select page, (length('# ' || page || chr(10) || chr(10) || '## Overview' || chr(10) || 'Text.' || chr(10) || chr(10) || '## Evidence') + n + 1)::bigint as n_chars, c + 1 as parts from b""",
}
