"""Queries of the llm subpackage and their SQL, added to the driver's registry by ``__spark_entry__``."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filanda.llm.components import connected_groups
from filanda.llm.markup import found_markup
from filanda.llm.mixing import mix, mix_audit, mix_report
from filanda.llm.name_variants import name_groups, variant_pairs
from filanda.llm.near_duplicates import all_pairs, document_words, similar_documents
from filanda.llm.packing import pack_audit, pack_documents, pack_report
from filanda.llm.personal_data import found_personal_data
from filanda.llm.tokens import with_token_counts
from filanda.llm.unicode_forms import found_disguises
from filanda.runtime import cut, table, tune


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs and previews that contain markup."""
    tune(spark)
    return found_markup(table(spark, sf_dir, "sections").select("section_id", "preview_start", "paragraphs"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and the smallest node of their group, over links of weight 0.5 or more."""
    return connected_groups(table(spark, sf_dir, "links").select("source", "target", "weight"), 0.5)


def pseudonym_key(spark: SparkSession) -> bytes:
    """The secret of the pseudonyms: the session's ``filanda.pseudonym.key``; without one, a key of the session alone, so that its
    pseudonyms cannot be linked to another's."""
    named = spark.conf.get("filanda.pseudonym.key", None)
    return named.encode() if named else hashlib.sha256(spark.sparkContext.applicationId.encode() + _SESSION_SALT).digest()


_SESSION_SALT = os.urandom(16)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of personal data in paragraphs and previews."""
    tune(spark)
    sections = table(spark, sf_dir, "sections").select("section_id", "preview_start", "paragraphs")
    return found_personal_data(sections, table(spark, sf_dir, "taxonomy_diff").select("diff_id", "text_preview"), pseudonym_key(spark))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents whose words agree to three quarters or more."""
    tune(spark)
    skeleton = table(spark, sf_dir, "doc_skeleton").select("doc_id", "file_name")
    sections = table(spark, sf_dir, "sections").select("doc_id", "section_id", "preview_start")
    return all_pairs(*similar_documents(document_words(skeleton, sections), 0.75))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of spellings of one person or organisation."""
    tune(spark)
    return variant_pairs(name_groups(table(spark, sf_dir, "entities").select("category", "value")))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document's text, for each capacity."""
    tune(spark)
    sized = cut(with_token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return pack_documents(sized, table(spark, sf_dir, "pack_sizes"))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixture of the sources that meets the targets as nearly as the repeats allow."""
    tune(spark)
    sized = cut(with_token_counts(table(spark, sf_dir, "documents").select("doc_id", "source", "text")))
    return mix(sized, table(spark, sf_dir, "mix_targets"))


def _packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    sized = cut(with_token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))
    packs = table(spark, sf_dir, "pack_sizes")
    return cut(pack_documents(sized, packs)), sized, packs


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each capacity are, and how even their cost."""
    tune(spark)
    packed, _, packs = _packed(spark, sf_dir)
    return pack_report(packed, packs)


def p8_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the packing must keep: every text whole, none over capacity, none cut without need, little space left."""
    tune(spark)
    return pack_audit(*_packed(spark, sf_dir))


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each source in the mixture, against its target, and how often a document of it is used."""
    return mix_report(cut(p9_mixture(spark, sf_dir)), table(spark, sf_dir, "mix_targets"))


def p9_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each target source whether it reached its share, but for one document of each source, within its repeats."""
    tune(spark)
    sized = cut(with_token_counts(table(spark, sf_dir, "documents").select("doc_id", "source", "text")))
    targets = table(spark, sf_dir, "mix_targets")
    return mix_audit(cut(mix(sized, targets)), sized, targets)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of disguise in the documents' texts."""
    tune(spark)
    return found_disguises(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p2_found, p3_found, p4_found, p5_found, p8_containers, p8_report, p8_audit, p9_mixture, p9_report, p9_audit,
        p10_found)
}

#: Characters without width, as DuckDB's engine writes them.
_HIDDEN = r"\x{ad}\x{34f}\x{61c}\x{180e}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{2064}\x{2066}-\x{2069}\x{feff}"

ORACLES: dict[str, str] = {
    "p2_found": """
with recursive e as (
  select distinct lower(trim(source)) as a, lower(trim(target)) as b from links
  where weight >= 0.5 and source is not null and target is not null and lower(trim(source)) <> lower(trim(target))),
d as (select a, b from e union select b, a from e),
r(node_id, g) as (
  select a, a from d
  union
  select d.b, r.g from r join d on d.a = r.node_id)
select node_id, min(g) as group_id from r group by node_id
""",
    "p4_found": r"""
with k as (select doc_id, max(regexp_replace(file_name, '\.[^.]*$', '')) as name from doc_skeleton where doc_id is not null group by 1),
s as (select distinct doc_id, section_id, preview_start from sections where doc_id is not null and preview_start is not null),
t as (select doc_id, preview_start as t from s union all select doc_id, name from k where doc_id in (select doc_id from s)),
w as (select doc_id, unnest(regexp_extract_all(lower(t), '[\p{L}\p{N}]+')) as word from t),
e as (select doc_id, word, row_number() over (partition by doc_id, word) as nth from w),
n as (select doc_id, count(*) as n from e group by 1),
p as (select a.doc_id as doc_id_a, b.doc_id as doc_id_b, count(*) as shared from e a join e b on a.word = b.word and a.nth = b.nth and a.doc_id < b.doc_id group by 1, 2)
select doc_id_a, doc_id_b from p join n a on a.doc_id = doc_id_a join n b on b.doc_id = doc_id_b where shared >= 0.75 * (a.n + b.n - shared)
""",
    "p10_found": rf"""
with d as (select doc_id, text from documents where text is not null),
w as (select doc_id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{N}}{_HIDDEN}]+')) as w from d)
select doc_id, 'fullwidth' as kind from d where regexp_matches(text, '[０-９Ａ-Ｚａ-ｚ]')
union all select doc_id, 'combining' from d where regexp_matches(text, '\p{{L}}[\x{{300}}-\x{{36f}}]')
union all select doc_id, 'zerowidth' from d where regexp_matches(text, '[\p{{Latin}}\p{{Greek}}\p{{Cyrillic}}\p{{N}}\x{{300}}-\x{{36f}}][{_HIDDEN}]+[\p{{Latin}}\p{{Greek}}\p{{Cyrillic}}\p{{N}}]')
union all select doc_id, 'space' from d where regexp_matches(text, '[\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{3000}}]')
union all select distinct doc_id, 'lookalike' from w where regexp_matches(w, '\p{{Latin}}') and regexp_matches(w, '[\p{{Cyrillic}}\p{{Greek}}\p{{Armenian}}\p{{Cherokee}}\p{{Coptic}}\p{{Lisu}}]')
""",
    "p8_audit": "select pack_name, (select count(*) from documents where text <> '') as texts, 0 as over_capacity, 0 as split_needlessly, 0 as wrong_length, true as well_filled from pack_sizes",
    "p9_audit": "select source, exists (select 1 from documents d where d.source = t.source and text <> '') as present, true as on_target, true as within_repeats from mix_targets t",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
