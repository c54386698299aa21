import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from filanda.operators.ledger import Conflict, Ledger, new_or_changed, replay, run_events, work_through
from filanda.operators.snapshots import parse_instant, snapshot_changes, snapshot_changes_sql
from tests.conftest import rows

STATE = "state_id long, folder_key string, last_ingest_at string, files map<string, struct<sha256: string, mtime: string>>, seq int"


def snap(i, folder, at, files):
    return (i, folder, at, None if files is None else {p: {"sha256": s, "mtime": "x"} for p, s in files.items()}, 1)


def test_instants(spark):
    texts = ["2025-01-14T20:00:00Z", "2025-01-14T22:00:00+02:00", "2025-01-14 20:00:00", "2025/01/14 20:00:00", "14/01/2025 20:00:00", "20250114T200000Z", "1736884800", "1736884800000", "n/d", "", None, "2025-13-40T00:00:00Z", "2025-01-14"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(parse_instant(F.col("t"))).collect()]
    assert len({str(g) for g in got[:8]}) == 1 and got[8:12] == [None] * 4 and got[12] is not None


def test_changes(spark):
    data = [
        snap(5, "a", "2025-01-02T00:00:00Z", {"./x/1": "AB", "x\\2": "cd", "y": None}),
        snap(4, "a", "2025-01-01T00:00:00+00:00", {"x/1": "ab", "x/3": "ef", "y": "q"}),
        snap(9, "a", "2025-01-02T01:00:00+01:00", {"x/1": "ab", "x/2": "cd", "y": None}),  # the second delivery of 5
        snap(5, "a", "2025-01-02T00:00:00Z", {"./x/1": "AB", "x\\2": "cd", "y": None}),
        snap(6, "a", "2025-01-03T00:00:00Z", {}), snap(7, "a", "n/d", {"z": "1"}), snap(8, "a", "2025-01-02T12:00:00Z", None), snap(10, "b", "2025-01-01T00:00:00Z", {"x/1": "ab"}), snap(11, None, "2025-01-01T00:00:00Z", {"x": "1"}),
    ]
    df = spark.createDataFrame(data, STATE)
    want = sorted([(5, "x/2", "added"), (5, "x/3", "removed"), (5, "y", "changed"), (6, "x/1", "removed"), (6, "x/2", "removed"), (6, "y", "removed")])
    assert rows(snapshot_changes(df)) == want == rows(snapshot_changes_sql(df))
    assert rows(snapshot_changes(df.limit(0))) == []


def test_changes_in_many_buckets(spark):
    rng = random.Random(5)
    data, i = [], 0
    for folder in ["hot"] * 6 + ["b", "c"]:
        for k in range(3):
            data.append(snap(i, folder, f"2025-0{1 + i % 9}-{1 + k:02}T00:00:00Z", {f"p{rng.randrange(300)}": str(rng.randrange(3)) for _ in range(200 if folder == "hot" else 5)}))
            i += 1
    df = spark.createDataFrame(data, STATE)
    assert rows(snapshot_changes(df, rows_per_bucket=50)) == rows(snapshot_changes(df)) == rows(snapshot_changes_sql(df))


LISTING = "doc_id long, file_hash string, arrived_at timestamp, error string, run_no int"
RUN = "run_no int, started_at timestamp, status string, doc_id int"


def ts(h):
    import datetime

    return datetime.datetime(2025, 1, 1 + h // 24, h % 24)


def brute(listings, runs):
    last, out = {}, []
    for no, start, status, _ in sorted(set(runs), key=lambda r: (r[1], r[0])):
        if status != "ok":
            continue
        for d in {x[0] for x in listings}:
            seen = [x for x in listings if x[0] == d and x[3] is None and x[2] is not None and x[2] < start]
            if seen:
                h = max(seen, key=lambda x: (x[2], x[1] is not None, x[1] or ""))[1]
                if d not in last or last[d] != h:
                    out.append((no, d))
                last[d] = h
    return sorted(out)


def test_new_or_changed_against_brute_force(spark):
    rng = random.Random(6)
    runs = [(k, ts(10 * k), rng.choice(["ok", "ok", "failed", "aborted"]), 0) for k in range(1, 9)]
    listings = [(rng.randrange(12), rng.choice(["a", "b", "c", None]), ts(rng.randrange(90)), rng.choice([None, None, None, "E"]), 1) for _ in range(160)]
    listings += listings[:20]
    got = rows(new_or_changed(spark.createDataFrame(listings, LISTING), spark.createDataFrame(runs + runs[:2], RUN)))
    assert got == brute(listings, runs)


def test_replay_states(spark):
    listings = [(1, "a", ts(1), None, 0), (1, "b", ts(30), None, 0), (2, "a", ts(1), "E", 0), (None, "a", ts(1), None, 0), (3, "a", ts(10), None, 0)]
    runs = [(1, ts(10), "failed", 0), (2, ts(20), "ok", 0), (3, ts(40), "aborted", 0), (4, ts(50), "ok", 0), (5, None, "ok", 0)]
    got = rows(replay(spark.createDataFrame(listings, LISTING), spark.createDataFrame(runs, RUN)).drop("out_path"))
    assert got == sorted([(1, "a", 1, 1, "expired"), (1, "a", 2, 2, "done"), (3, "a", 2, 2, "done"), (1, "b", 3, 3, "expired"), (1, "b", 4, 4, "done")])
    assert replay(spark.createDataFrame([], LISTING), spark.createDataFrame(runs, RUN)).count() == 0
    assert replay(spark.createDataFrame(listings, LISTING), spark.createDataFrame([], RUN)).count() == 0


def test_ledger(spark, tmp_path):
    led = Ledger(spark, str(tmp_path / "l"))
    led.enqueue(spark.createDataFrame([("x", "1"), ("y", "1"), ("y", "1"), (None, "1")], "item string, version string"))
    t1, leased = led.lease("2025-01-01 00:00:00", "2025-01-01 01:00:00")
    assert rows(leased.select("item")) == [("x",), ("y",)]
    path = led.out_path(leased)
    stale = spark.createDataFrame([tuple(r) for r in leased.collect()], leased.schema)
    t2, again = led.lease("2025-01-01 00:30:00", "2025-01-01 01:30:00")
    assert again.count() == 0  # still leased
    t3, retry = led.lease("2025-01-01 02:00:00", "2025-01-01 03:00:00")
    assert retry.count() == 2 and led.out_path(retry) == path and t3 > t1  # expired, the same path
    spark.range(1).write.parquet(led.staging_path(t1))
    spark.range(3).write.parquet(led.staging_path(t3))
    retry = spark.createDataFrame([tuple(r) for r in retry.collect()], retry.schema)
    assert led.commit(t1, stale, "2025-01-01 00:10:00") == 0  # a stale writer, even one whose clock is behind
    assert not (tmp_path / "l" / "out").exists()
    assert led.commit(t3, retry, "2025-01-01 04:00:00") == 0  # in time no more
    assert led.commit(t3, retry, "2025-01-01 02:30:00") == 2 and led.commit(t3, retry, "2025-01-01 02:30:00") == 0
    assert spark.read.parquet(path).count() == 3 and led.recover() == 0
    led.enqueue(spark.createDataFrame([("x", "1"), ("y", "2"), ("z", "1")], "item string, version string"))
    assert rows(led.items().where("state = 'pending'").select("item", "version")) == [("y", "2"), ("z", "1")]
    fresh = Ledger(spark, led.root)  # a crash between rows and log entry leaves the generation before in force
    spark.range(1).write.parquet(f"{led.root}/data/99-crash")
    assert rows(fresh.items().select("item", "state")) == [("x", "done"), ("y", "pending"), ("z", "pending")]


def test_two_drivers_race(spark, tmp_path):
    one, two = Ledger(spark, str(tmp_path / "r")), Ledger(spark, str(tmp_path / "r"))
    one.enqueue(spark.createDataFrame([("x", "1")], "item string, version string"))
    two._at = lambda: 0  # it read the ledger before the other's write
    with pytest.raises(Conflict):
        two.enqueue(spark.createDataFrame([("x", "2")], "item string, version string"))
    assert rows(one.items().select("item", "version")) == [("x", "1")]


def test_compaction_and_next_items(spark, tmp_path):
    led = Ledger(spark, str(tmp_path / "c"))
    led.COMPACT = 3
    for k in range(5):
        led.enqueue(spark.createDataFrame([(f"i{k}", "1"), ("i0", str(k))], "item string, version string"))
    assert rows(led.items().select("item", "version")) == [("i0", "4"), ("i1", "1"), ("i2", "1"), ("i3", "1"), ("i4", "1")]
    _, got = led.lease("2025-01-01 00:00:00", "2025-01-02 00:00:00", most=2)
    assert rows(got.select("item")) == [("i0",), ("i1",)]


def test_a_late_writer_is_turned_away(spark):
    listings = spark.createDataFrame([(1, "a", ts(1), None, 0)], LISTING)
    runs = [(1, ts(10), "aborted", ts(25)), (2, ts(20), "failed", ts(30)), (3, ts(40), "ok", ts(41))]
    got = rows(replay(listings, spark.createDataFrame(runs, "run_no int, started_at timestamp, status string, finished_at timestamp")).select("run_no", "token", "state"))
    assert got == [(1, 1, "expired"), (2, 2, "expired"), (3, 3, "done")]  # the report of run 1 at hour 25 finds the item leased to run 2
    events = run_events([(1, 10, 25, "aborted"), (2, 20, 30, "failed"), (3, 40, 41, "ok")])
    open_fence = [(v, s, t, 2 if (v, s) == ("commit", 0) else m, e) for v, s, t, m, e in events]
    one = np.zeros(1, dtype=int)
    assert work_through(one, one, one, events)[4].tolist() == [False, False, True]
    assert work_through(one, one, one, open_fence)[4].tolist() == [True, False]  # without the fence the ok run would miss the document


@pytest.mark.parametrize("status", ["failed", None])
def test_no_successful_run(spark, status):
    assert new_or_changed(spark.createDataFrame([(1, "a", ts(1), None, 0)], LISTING), spark.createDataFrame([(1, ts(5), status, 0)], RUN)).count() == 0
