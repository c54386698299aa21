"""Queries over Markdown, prose, notes and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filanda.functions import text as T
from filanda.functions import typography as Y
from filanda.operators import lint as L
from filanda.operators import notes as N
from filanda.operators import prose as P
from filanda.plans import patterns as R
from filanda.runtime import table


def _paras(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "sections").distinct().select("section_id", F.posexplode("paragraphs").alias("n", "text"))
    return s.select(F.concat_ws("-", F.col("section_id").cast("string"), F.col("n").cast("string")).alias("path"), "text")


def table_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective rows of Markdown tables in paragraphs."""
    return L.table_defects(_paras(spark, sf_dir))


def shell_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken continuations where each paragraph is a shell block, its sentences being lines that go on: at the block's end or, every other one, before a blank line."""
    body = F.concat(F.lit("```bash\n"), F.replace("text", F.lit(". "), F.lit(" \\\n")), F.lit(" \\\n"), F.when(F.length("text") % 2 == 0, "\n").otherwise(""), F.lit("```"))
    return L.shell_defects(_paras(spark, sf_dir).where("not contains(text, '`') and not contains(text, '~')").withColumn("text", body))


def prose_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signs of the prose families P1 to P6, and the lines they stand on; a document is the paragraphs of its sections in order."""
    s = table(spark, sf_dir, "sections").distinct().where("paragraphs is not null")
    one = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", "section_id", "paragraphs"))), lambda x: x["paragraphs"])),
        "\n\n")
    found = P.prose_signs(s.groupBy(F.col("doc_id").alias("path")).agg(one.alias("text")))
    return found.groupBy("family").agg(F.count_distinct("path", "line_no").alias("lines"), F.count("*").alias("matches"))


def planted_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by family of sign other than uniformity, each with a paragraph before it that holds one; the texts themselves have none of these."""
    s = table(spark, sf_dir, "sections").distinct().where("paragraphs is not null")
    one = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", "section_id", "paragraphs"))), lambda x: x["paragraphs"])), "\n\n")
    more = F.array(*[F.lit(x) for x in ("Gli esperti ritengono che cambi.", "Non è burocrazia: è altro.", "Il prodotto è pronto. Veloce. Semplice. Potente.", "Kinda wild.", "We delve into it.")])
    texts = s.groupBy(F.col("doc_id").alias("path")).agg(one.alias("text"))
    texts = texts.select("path", F.concat(F.element_at(more, (F.col("path") % 5 + 1).cast("int")), F.lit("\n\n"), "text").alias("text"))
    return P.prose_signs(texts).where("family <> 'P1'").groupBy("family").agg(F.count_distinct("path").alias("docs"))


def accent_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that change when apostrophes for accents are replaced."""
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text", Y.accents("text").alias("fixed"))
    return d.where("text <> fixed").select("doc_id", F.length("fixed").alias("n_chars"))


def unwrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document before and after joining wrapped ones."""
    lines = lambda c: F.size(F.split(c, "\n"))
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", lines("text").alias("lines"),
        lines(Y.unwrap("text")).alias("joined"))


def note_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of a document's previews, of every section, that other documents have in their title, with the number of these;
    ``note_targets`` has the other end."""
    return N.linked_words(table(spark, sf_dir, "sections").select("doc_id", F.col("preview_start").alias("text")), _titles(spark, sf_dir))


def note_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of titles, each with every document it names."""
    return N.title_words(_titles(spark, sf_dir))


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "doc_skeleton").groupBy("doc_id").agg(F.max("file_name").alias("name"))


def index_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by type, the first fifty names of each."""
    return N.index_sections(table(spark, sf_dir, "doc_skeleton").select("doc_id", F.col("file_name").alias("name")).distinct())


def scan_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders whose snapshots stopped changing in size for two deliveries."""
    s = table(spark, sf_dir, "ingest_state").where("files is not null")
    return L.stalled(s.select(F.col("folder_key").alias("job"), F.col("state_id").alias("poll_no"), F.size("files").alias("done")).distinct(), 2)


def size_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth of each listed file over thirty days before its last listing."""
    k = table(spark, sf_dir, "doc_skeleton").where("error is null and arrived_at is not null")
    return L.growth_since(k.groupBy(F.col("relative_path").alias("path"),
        F.col("arrived_at").alias("at")).agg(F.max("file_size_bytes").alias("n_chars")), 30)


def title_similarity_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of one document with like titles, by their words."""
    s = table(spark, sf_dir, "sections").distinct().where("title is not null").select("doc_id", "section_id", T.class_tokens("title").alias("t"))
    a, b = s.select("doc_id", F.col("section_id").alias("a"), F.col("t").alias("ta")), s.select("doc_id", F.col("section_id").alias("b"),
        F.col("t").alias("tb"))
    return a.join(b, "doc_id").where("a < b").select("a", "b", F.round(T.jaccard("ta", "tb"), 4).alias("sim")).where("sim >= 0.5")


QUERIES = {f.__name__: f for f in (table_defects, shell_defects, prose_families, planted_signs, accent_fixes, unwrapped, note_links, note_targets, index_sections,
    scan_progress, size_growth, title_similarity_pairs)}

_STOP, _NOISE, _TYPE = R.CLASS_STOP, R.NAME_NOISE, R.DOC_TYPE.format("lower(name)")
_TITLE_WORDS = rf"""
with k as (select doc_id, max(file_name) as name from doc_skeleton group by 1),
w as (select distinct doc_id as target, token from (select doc_id, unnest(regexp_extract_all(lower(regexp_replace(name, '(.)\.[^.]*$', '\1')), '[a-z0-9]+')) as token from k) where length(token) >= 4 and token not in ({_NOISE}))
"""
def _accented(column: str) -> str:
    """The words of the specification with an apostrophe for their accent, replaced one after the other; what follows the apostrophe is kept as a group."""
    acute = "perche poiche affinche finche benche giacche anziche ne se".split()
    grave = "citta qualita attivita possibilita universita societa gia piu cosi puo cio sara potra dovra verra lunedi martedi mercoledi giovedi venerdi pero cioe".split()
    put = {"a": "à", "e": "è", "i": "ì", "o": "ò", "u": "ù"}
    end = r"''([^\p{L}]|$)"
    out = column
    for w in acute:
        out = f"regexp_replace({out}, '(?i)\\b({w[:-1]})e{end}', '\\1é\\2', 'g')"
    for w in grave:
        out = f"regexp_replace({out}, '(?i)\\b({w[:-1]}){w[-1]}{end}', '\\1{put[w[-1]]}\\2', 'g')"
    out = f"regexp_replace({out}, '(^|[^\\p{{L}}''])e{end}', '\\1è\\2', 'g')"
    out = f"regexp_replace({out}, '\\bsta''', 'sta' || chr(2), 'g')"  # the one elision of three letters
    for v in "aiou":
        out = f"regexp_replace({out}, '\\b([A-Za-z]{{2,}}){v}{end}', '\\1{put[v]}\\2', 'g')"
    return f"replace({out}, chr(2), '''')"


_PARAS = "select distinct section_id || '-' || (generate_subscripts(paragraphs, 1) - 1) as path, unnest(paragraphs) as text from (select distinct section_id, paragraphs from sections)"
_LINES = """
l as (select path, generate_subscripts(ls, 1) as n, unnest(ls) as line from (select path, string_split(text, chr(10)) as ls from p where text is not null)),
f as (select *, regexp_matches(line, '^\\s*(```|~~~)') as fence from l),
o as (select *, sum(fence::int) over (partition by path order by n rows unbounded preceding) % 2 = 1 or fence as code from f)"""
ORACLES = {
    "planted_signs": "select ['P2', 'P3', 'P4', 'P5', 'P6'][doc_id % 5 + 1] as family, count(distinct doc_id) as docs from sections where paragraphs is not null group by 1",
    "accent_fixes": f"""
with d as (select doc_id, text, string_split(regexp_replace(text, '(?s)(```.*?(?:```|\\z)|`[^`\\n]*`)', chr(1) || '\\1' || chr(1), 'g'), chr(1)) as ps from documents where text is not null),
q as (select doc_id, generate_subscripts(ps, 1) as i, unnest(ps) as p from d),
f as (select doc_id, string_agg(case when i % 2 = 1 then {_accented('p')} else p end, '' order by i) as fixed from q group by 1)
select doc_id, length(fixed) as n_chars from f join d using (doc_id) where text <> fixed""",
    "unwrapped": r"""
with d as (select doc_id, text, string_split(regexp_replace(text, '(?s)(```.*?(?:```|\z))', chr(1) || '\1' || chr(1), 'g'), chr(1)) as ps from documents where text is not null),
q as (select doc_id, generate_subscripts(ps, 1) as i, unnest(ps) as p from d),
l as (select doc_id, i, generate_subscripts(ls, 1) as n, unnest(ls) as line from (select doc_id, i, string_split(p, chr(10)) as ls from q where i % 2 = 1)),
x as (select doc_id, line, lead(line) over (partition by doc_id, i order by n) as nxt from l),
j as (select doc_id, count(*) as gone from x where nxt is not null and regexp_matches(line, '\S$') and not ends_with(line, '|') and not regexp_matches(line, '^#{1,6}\s')
  and regexp_matches(nxt, '^\S') and not regexp_matches(nxt, '^(?:#{1,6}(?:\s|$)|[-*+](?:\s|$)|[0-9]+[.)](?:\s|$)|>|\||```|<)') group by 1)
select d.doc_id, len(string_split(text, chr(10)))::int as lines, (len(string_split(text, chr(10))) - coalesce(gone, 0))::int as joined from d left join j on j.doc_id = d.doc_id""",
    "table_defects": f"with p as ({_PARAS}), {_LINES.strip()}," + r"""
t as (select path, n, line, regexp_matches(trim(line), '^\|.*\|$') as is_row, len(string_split(regexp_replace(regexp_replace(trim(line), '\\\|', '', 'g'), '^\||\|$', '', 'g'), '|')) as cells from o
  where not code and (regexp_matches(trim(line), '^\|.*\|$') or regexp_matches(line, '^\s*\+[-=+]+\+\s*$'))),
r as (select *, n - row_number() over (partition by path order by n) as run from t),
g as (select *, bool_or(regexp_matches(line, '^\s*\+')) over (partition by path, run) as figure, max(case when regexp_matches(line, '^\s*\|[\s:|-]*-[\s:|-]*\|\s*$') then cells end) over (partition by path, run) as want from r)
select path, n::int as line_no, case when want is null then 'detached' else 'cells' end as defect from g where not figure and (want is null or cells <> want)""",
    "shell_defects": f"with q as ({_PARAS}), p as (select path, '```bash' || chr(10) || replace(text, '. ', ' ' || chr(92) || chr(10)) || ' ' || chr(92) || chr(10) || case when length(text) % 2 = 0 then chr(10) else '' end || '```' as text from q "
    f"where not contains(text, '`') and not contains(text, '~')), {_LINES.strip()}," + r"""
x as (select *, lead(line) over (partition by path order by n) as nxt from o where code)
select path, n::int as line_no, case when regexp_matches(nxt, '^\s*(```|~~~)') then 'open-continuation' else 'broken-continuation' end as defect from x
where not fence and regexp_matches(line, '\\\s*$') and (regexp_matches(nxt, '^\s*(```|~~~)') or trim(nxt) = '')""",
    "note_links": _TITLE_WORDS + r""",
s as (select distinct doc_id, unnest(regexp_extract_all(lower(preview_start), '[a-z0-9]+')) as token from sections where preview_start is not null),
n as (select s.doc_id, s.token, count(*) as n_targets from s join w on s.token = w.token and s.doc_id <> w.target group by all)
select * from n""",
    "note_targets": _TITLE_WORDS + "select token, target from w",
    "index_sections": f"""
with t as (select name, {_TYPE} as doc_type from (select distinct doc_id, file_name as name from doc_skeleton)),
r as (select *, row_number() over (partition by doc_type order by name) as r, count(*) over (partition by doc_type) as n_docs from t)
select doc_type, n_docs, string_agg('- ' || name, chr(10) order by r) as listing from r where r <= 50 group by 1, 2""",
    "scan_progress": """
with s as (select distinct folder_key as job, state_id as poll_no, cardinality(files) as done from ingest_state where files is not null),
x as (select *, coalesce((done = lag(done) over (partition by job order by poll_no))::int, 0) as same from s),
y as (select *, sum(same) over (partition by job order by poll_no rows 1 preceding) as run from x)
select job, min(poll_no) as stalled_at from y where run >= 2 group by 1""",
    "size_growth": """
with k as (select relative_path as path, arrived_at as t, max(file_size_bytes) as n from doc_skeleton where error is null and arrived_at is not null group by 1, 2),
l as (select path, max(t) as latest, arg_max_null(n, t) as n_chars from k group by 1),
o as (select k.path, arg_max_null(n, t) as was from k join l using (path) where t <= latest - interval 30 day group by 1)
select l.path, n_chars, n_chars - coalesce(was, 0) as growth from l left join o using (path)""",
    "title_similarity_pairs": f"""
with s as (select doc_id, section_id, list_distinct(list_filter(regexp_extract_all(lower(title), '[a-z][a-z0-9+#.]{{2,}}'), lambda t: t not in ({_STOP}))) as t from (select distinct * from sections) where title is not null),
p as (select a.section_id as a, b.section_id as b, case when len(a.t) = 0 or len(b.t) = 0 then 0.0 else round(len(list_intersect(a.t, b.t))::double / len(list_distinct(list_concat(a.t, b.t))), 4) end as sim from s a join s b on a.doc_id = b.doc_id and a.section_id < b.section_id)
select * from p where sim >= 0.5""",
}
