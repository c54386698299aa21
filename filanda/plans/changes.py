"""Queries over snapshots and listings: what changed, and what a run has to process."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filanda.operators.ledger import new_or_changed
from filanda.operators.snapshots import snapshot_changes
from filanda.runtime import table, tune


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths added, removed or changed between consecutive snapshots of a folder."""
    tune(spark)
    return snapshot_changes(table(spark, sf_dir, "ingest_state"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents new or changed for each successful run since the last one."""
    return new_or_changed(table(spark, sf_dir, "doc_skeleton"), table(spark, sf_dir, "scan_runs"))


QUERIES = {"p6_found": p6_found, "p7_found": p7_found}

ORACLES = {
    "p6_found": r"""
with s as (
  select folder_key, try_cast(last_ingest_at as timestamptz) as inst, min(state_id) as state_id
  from ingest_state where files is not null and folder_key is not null and try_cast(last_ingest_at as timestamptz) is not null group by all),
o as (select *, row_number() over (partition by folder_key order by inst) as seq from s),
f as (
  select o.folder_key, o.seq, regexp_replace(replace(x.key, '\', '/'), '^(\./+)+', '') as rel_path, min(lower(x.value.sha256)) as sha
  from o join (select distinct state_id, unnest(map_entries(files)) as x from ingest_state where files is not null) using (state_id) group by all),
c as (
  select coalesce(n.folder_key, p.folder_key) as folder_key, coalesce(n.seq, p.seq + 1) as seq, coalesce(n.rel_path, p.rel_path) as rel_path,
    case when p.seq is null then 'added' when n.seq is null then 'removed' when n.sha is distinct from p.sha then 'changed' end as change
  from f n full join f p on n.folder_key = p.folder_key and n.seq = p.seq + 1 and n.rel_path = p.rel_path)
select o.state_id, c.rel_path, c.change from c join o using (folder_key, seq) where change is not null and seq > 1
""",
    "p7_found": """
with r as (select distinct run_no, started_at from scan_runs where status = 'ok'),
l as (select distinct doc_id, file_hash, arrived_at from doc_skeleton where error is null and doc_id is not null),
s as (select r.run_no, r.started_at, doc_id, arg_max(file_hash, arrived_at) as h from l join r on l.arrived_at < r.started_at group by all),
p as (select *, lag(h) over w as ph, row_number() over w as k from s window w as (partition by doc_id order by started_at))
select run_no, doc_id from p where k = 1 or ph is distinct from h
""",
}
