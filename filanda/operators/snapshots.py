"""What changed between consecutive full snapshots of keyed tables.

Keys and rows are reduced to 64-bit hashes and spread over hash buckets; a bucket's hashes are
sorted in numpy and consecutive snapshots compared by ``searchsorted`` set differences. Only the
differing keys are looked up again for their full values. Two different keys (or rows) of one
folder whose 64-bit hashes agree would be taken for one; for a folder of a million paths that has
a probability below 1e-7.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filanda.runtime import cut

CHANGES = ("added", "removed", "changed")


def parse_instant(text: Column) -> Column:
    """ISO-like notations with T or blank, any fraction, Z or an offset, also compact or day-first; null if unusable.

    Notations without a zone are UTC; a bare date is its midnight; bare digits are epoch seconds or milliseconds.
    """
    t = F.trim(text)
    iso = F.regexp_replace(F.regexp_replace(t, r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3"), r"\s*(UTC|GMT)$", "Z")
    day_first = r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4})(.*)$"
    compact = r"^(\d{4})(\d\d)(\d\d)T?(\d\d)(\d\d)(\d\d)(.*)$"
    return (
        F.when(t.rlike(r"^\d{10}(\.\d+)?$"), F.timestamp_seconds(t.try_cast("double")))
        .when(t.rlike(r"^\d{13}$"), F.timestamp_millis(t.try_cast("bigint")))
        .when(t.rlike(compact), F.regexp_replace(t, compact, "$1-$2-$3T$4:$5:$6$7").try_cast("timestamp"))
        .when(t.rlike(day_first), F.concat(F.regexp_replace(t, day_first, "$3-$2-$1"), F.regexp_replace(t, day_first, "$4")).try_cast("timestamp"))
        .when(iso.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([T ].*)?$"), iso.try_cast("timestamp"))
    )


def normal_path(path: Column) -> Column:
    """Forward slashes, without leading ``./`` (also repeated)."""
    return F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"^(\./+)+", "")


def snapshot_order(states: DataFrame) -> DataFrame:
    """Usable snapshots: ``state_id, folder_key, seq, n_seq``, one row for each folder and instant, numbered from 1.

    A snapshot delivered again (same folder, same instant) counts once, under its smallest state_id. Rows with null ``files``,
    null ``folder_key`` or an unusable instant are left out; empty maps stay. The maps themselves are neither sorted nor shuffled.
    """
    usable = states.where("files is not null and folder_key is not null and state_id is not null").select("state_id", "folder_key",
        parse_instant(F.col("last_ingest_at")).alias("at")).where("at is not null")
    first = usable.groupBy("folder_key", "at").agg(F.min("state_id").alias("state_id"))
    w = Window.partitionBy("folder_key")
    return first.select("state_id", "folder_key", F.row_number().over(w.orderBy("at")).alias("seq"), F.count("*").over(w).cast("int").alias("n_seq"))


def _members(needle: np.ndarray, hay: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each needle in the sorted hay, and whether it is there."""
    at = np.searchsorted(hay, needle)
    found = np.zeros(len(needle), dtype=bool)
    inside = at < len(hay)
    found[inside] = hay[at[inside]] == needle[inside]
    return at, found


def _compare_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Changes of one bucket: its entries as codes (rank of the snapshot, rank of the key) in one sorted array, searched for those
    of the neighbouring snapshots."""
    folder, seq, n_seq, key, row = (pdf[c].to_numpy() for c in ("folder", "seq", "n_seq", "k", "r"))
    keys, key = np.unique(key, return_inverse=True)
    order = np.lexsort((row, key, seq, folder))
    folder, seq, n_seq, key, row = folder[order], seq[order], n_seq[order], key[order], row[order]
    new_snap = np.concatenate([[True], (folder[1:] != folder[:-1]) | (seq[1:] != seq[:-1])])
    snap = np.cumsum(new_snap) - 1  # ranks of the snapshots that have an entry in this bucket
    first = np.flatnonzero(new_snap)
    # the rank of the snapshot before and after, -1 where it has no entry here; no rank pair can overflow, as ranks are below the bucket's rows
    near = (folder[first][1:] == folder[first][:-1]) & (seq[first][1:] == seq[first][:-1] + 1)
    before = np.concatenate([[-1], np.where(near, np.arange(len(first) - 1), -1)])
    after = np.concatenate([np.where(near, np.arange(1, len(first)), -1), [-1]])
    width = np.int64(len(keys))
    code = snap * width + key
    one = np.concatenate([[True], code[1:] != code[:-1]])  # under one key the smallest row hash counts
    code, row, snap, seq, n_seq, folder, key = (x[one] for x in (code, row, snap, seq, n_seq, folder, key))
    at, kept = _members(np.where(before[snap] >= 0, before[snap] * width + key, -1), code)
    changed = np.zeros(len(code), dtype=bool)
    changed[kept] = row[at[kept]] != row[kept]
    _, goes_on = _members(np.where(after[snap] >= 0, after[snap] * width + key, -1), code)
    picks = [((seq > 1) & ~kept, 0, 0), ((seq < n_seq) & ~goes_on, 1, 1), (changed, 2, 0)]
    part = lambda m, c, ahead: pd.DataFrame({"folder": folder[m], "seq": (seq[m] + ahead).astype("int32"), "k": keys[key[m]],
        "code": np.full(m.sum(), c, dtype="int32")})
    return pd.concat([part(*p) for p in picks], ignore_index=True)


def snapshot_changes(states: DataFrame, rows_per_bucket: int = 200_000) -> DataFrame:
    """``state_id, rel_path, change`` between consecutive snapshots of each folder.

    ``states`` has ``state_id, folder_key, last_ingest_at, files map<path, struct<sha256, mtime>>``;
    further columns are ignored. Paths compare after ``normal_path``, digests in lower case; a null
    digest equals a null digest only. A path null or empty is left out. Where one snapshot lists a path
    twice in different notations, one listing (the smaller row hash) counts. Identical copies of a row count once. An empty
    table, and a folder's first snapshot, give no rows.

    Entries move as hashes only, spread over ``ceil(rows / rows_per_bucket)`` buckets by the hash of folder and path, so that
    a folder may hold any share of them. The differing keys become a table whose size the optimizer knows: it is broadcast to the
    entries while it is small, else it filters them before they are shuffled; only entries found there are read for their full value.
    """
    order = cut(snapshot_order(states.select("state_id", "folder_key", "last_ingest_at", "files")))
    maps = states.where("files is not null and folder_key is not null").select("state_id", "folder_key", "files")
    heads = maps.join(order, ["state_id", "folder_key"]).select("folder_key", "seq", "n_seq", "files")
    sizes = maps.agg(F.ceil(F.coalesce(F.sum(F.size("files")), F.lit(0)) / rows_per_bucket).cast("int")).first()
    n_buckets = max(1, sizes[0])
    entries = heads.select("folder_key", "seq", "n_seq", F.explode("files").alias("path", "f")).select("folder_key", "seq", "n_seq",
        normal_path(F.col("path")).alias("rel_path"), F.lower(F.trim("f.sha256")).alias("sha")).where("rel_path <> ''")
    folder, k = F.xxhash64("folder_key"), F.xxhash64("folder_key", "rel_path")
    row = F.xxhash64(F.col("sha").isNull(), F.coalesce("sha", F.lit("")))
    hashed = entries.select(folder.alias("folder"), "seq", "n_seq", k.alias("k"), row.alias("r")).withColumn("bucket",
        F.pmod("k", F.lit(n_buckets)).cast("int"))
    diffs = hashed.groupBy("bucket").applyInPandas(lambda pdf: _compare_bucket(pdf), "folder long, seq int, k long, code int")
    # full values only for the differing keys: in the later snapshot, or for removed keys in the one before
    ids = order.select(folder.alias("folder"), "seq", "state_id")
    in_seq = F.col("seq") - F.when(F.col("code") == 1, 1).otherwise(0)
    wanted = cut(diffs.join(ids, ["folder", "seq"]).select("k", in_seq.alias("in_seq"), "state_id", "code"))
    names = entries.select(k.alias("k"), F.col("seq").alias("in_seq"), "rel_path")
    change = F.element_at(F.array(*[F.lit(c) for c in CHANGES]), F.col("code") + 1)
    return names.join(wanted, ["k", "in_seq"]).select("state_id", "rel_path", change.alias("change")).distinct()


def snapshot_changes_sql(states: DataFrame) -> DataFrame:
    """The same result as a plain full outer join; the operator's reference in tests."""
    snaps = snapshot_order(states)
    e = cut(states.where("files is not null").select("state_id", "folder_key", "files").join(snaps, ["state_id", "folder_key"]).select("folder_key",
        "seq", F.explode("files").alias("p", "f")).select("folder_key", "seq", normal_path(F.col("p")).alias("rel_path"),
        F.lower(F.trim("f.sha256")).alias("sha")).where("rel_path <> ''").groupBy("folder_key", "seq", "rel_path").agg(F.min("sha").alias("sha")))
    heads = snaps.select("folder_key", "seq", "state_id")
    old = e.select("folder_key", (F.col("seq") + 1).alias("seq"), "rel_path", F.col("sha").alias("old"), F.lit(True).alias("was"))
    both = e.withColumn("is", F.lit(True)).join(old, ["folder_key", "seq", "rel_path"], "full").join(heads, ["folder_key", "seq"]).where("seq > 1")
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").when(~F.col("sha").eqNullSafe(F.col("old")), "changed")
    return both.select("state_id", "rel_path", change.alias("change")).where("change is not null")


# ------------------------------------------------------------------------------------------ verbs on the state of ingest

STATE = "folder_key string, label string, last_ingest_at string, last_ingest_commit string, files map<string, struct<sha256: string, mtime: string>>"


def folder_files(listing: DataFrame) -> DataFrame:
    """``folder_key, files``: each folder's present files as one map. ``listing``: ``folder_key, path, sha256, mtime``; of a path
    listed twice the largest digest counts."""
    one = listing.where("folder_key is not null and path is not null").groupBy("folder_key",
        normal_path(F.col("path")).alias("path")).agg(F.max(F.struct("sha256", "mtime")).alias("f"))
    return one.groupBy("folder_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("path", "f")))).alias("files"))


def track(state: DataFrame, listing: DataFrame, now: str, commit: str, labels: DataFrame | None = None) -> DataFrame:
    """The state with every listed folder taken at ``now`` under ``commit``: new folders are added, known ones keep their label.
    ``labels``: ``folder_key, label`` for new ones; else the key."""
    new = folder_files(listing)
    names = state.select("folder_key", "label")
    fresh = new.join(names, "folder_key", "left")
    if labels is not None:
        fresh = fresh.join(labels.select("folder_key", F.col("label").alias("_l")), "folder_key", "left").withColumn("label",
            F.coalesce("label", "_l"))
    fresh = fresh.select("folder_key", F.coalesce("label", "folder_key").alias("label"), F.lit(now).alias("last_ingest_at"),
        F.lit(commit).alias("last_ingest_commit"), "files")
    return state.select("folder_key", "label", "last_ingest_at", "last_ingest_commit", "files").join(new.select("folder_key"), "folder_key",
        "left_anti").unionByName(fresh)


def resnapshot(state: DataFrame, listing: DataFrame) -> DataFrame:
    """The state with the present files of listed folders it knows; date and commit of their ingest stay, and folders it does not
    know are not added."""
    new = folder_files(listing).withColumnRenamed("files", "_files")
    return state.join(new, "folder_key", "left").select("folder_key", "label", "last_ingest_at", "last_ingest_commit",
        F.coalesce("_files", "files").alias("files"))


def untrack(state: DataFrame, folders: DataFrame) -> DataFrame:
    """The state without the named folders (``folder_key``)."""
    return state.join(folders.select("folder_key").distinct(), "folder_key", "left_anti")
