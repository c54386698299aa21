"""Work-item ledger: each run processes only what is new or changed since the last successful run.

Two forms share one rule set:

* ``Ledger`` keeps a durable table of work items (pending, leased, done) on any Hadoop file system. A run leases pending items
  under a fencing token that grows with every lease, writes its results to a staging folder of that token, and commits. A lease
  that expires returns its items to pending; a commit whose items were leased again, or whose lease is over, is rejected and its
  staging folder never becomes visible; a retry of the same items ends at the same path.
* ``replay`` works a whole history of listings and runs through the same states at once: buckets of items, each run's
  verbs applied to whole arrays.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "item string, version string, state string, token long, lease_until timestamp, out_path string"
PENDING, LEASED, DONE = 1, 2, 3
#: Runs of one history at most; they are held by the driver and by every task.
MAX_RUNS = 100_000


def run_events(runs: list[tuple[int, int, int | None, str | None]]) -> list[tuple[str, int, int, int, int]]:
    """The verbs of a history in order: ``(verb, slot, time, token, lease end)``, from ``(run_no, start, end, status)``.

    A run leases when it starts; its place among the runs is its fencing token. An ok run commits before the next one starts. The
    lease of any other run is over when that run ends, and at the latest when the next one starts; if it has an end and was not plainly
    ``failed``, its writer is taken to report at that end all the same, and the ledger has to turn it away.
    """
    out: list[tuple[str, int, int, int, int]] = []
    order = sorted(runs, key=lambda r: (r[1], r[0]))
    late: list[tuple[str, int, int, int, int]] = []
    for slot, (_, start, end, status) in enumerate(order):
        due = [x for x in late if x[2] <= start]
        late = [x for x in late if x[2] > start]
        out += sorted(due, key=lambda x: (x[2], x[1]))
        nxt = order[slot + 1][1] if slot + 1 < len(order) else np.iinfo(np.int64).max
        ok = status == "ok"
        until = max(start, end if end is not None else start) + 1 if ok else min(end if end is not None else nxt, nxt)
        out.append(("lease", slot, start, slot + 1, until))
        if ok:
            out.append(("commit", slot, until - 1, slot + 1, until))
        elif end is not None and status != "failed":
            late.append(("commit", slot, end, slot + 1, until))
    return out + sorted(late, key=lambda x: (x[2], x[1]))


def work_through(items: np.ndarray, slots: np.ndarray, versions: np.ndarray, events: list[tuple[str, int, int, int, int]]) -> tuple[np.ndarray, ...]:
    """Every lease as arrays ``item, version, slot, token, committed``.

    ``items`` (0..n-1), ``slots`` and ``versions`` (codes) say which version of an item the run of a slot is the first to see. The items'
    states are arrays: a listing in another version than the one last done makes its item pending, in that version makes it done; leases take
    what is pending; a commit counts for the items that its token still holds in time.
    """
    order = np.argsort(slots, kind="stable")
    items, slots, versions = items[order], slots[order], versions[order]
    n = int(items.max()) + 1 if len(items) else 0
    state, token = np.zeros(n, dtype=np.int8), np.zeros(n, dtype=np.int64)
    until, version, done = np.zeros(n, dtype=np.int64), np.full(n, -1), np.full(n, -1)
    leases: dict[int, list[np.ndarray]] = {}
    for verb, slot, time, mark, end in events:
        if verb == "lease":
            state[(state == LEASED) & (until <= time)] = PENDING
            lo, hi = np.searchsorted(slots, [slot, slot + 1])
            seen = items[lo:hi]
            moved = version[seen] != versions[lo:hi]
            version[seen] = versions[lo:hi]
            state[seen] = np.where(version[seen] == done[seen], DONE, np.where(moved | (state[seen] != LEASED), PENDING, LEASED))
            mine = np.flatnonzero(state == PENDING)
            state[mine], token[mine], until[mine] = LEASED, mark, end
            leases[slot] = [mine, version[mine], np.full(len(mine), mark), np.zeros(len(mine), dtype=bool)]
        else:
            mine = leases[slot][0]
            held = (state[mine] == LEASED) & (token[mine] == mark) & (time < until[mine])
            leases[slot][3] = held
            got = mine[held]
            state[got], done[got] = DONE, version[got]
    parts = [(a, b, np.full(len(a), s), c, d) for s, (a, b, c, d) in leases.items()]
    empty = (np.zeros(0, dtype=np.int64),) * 4 + (np.zeros(0, dtype=bool),)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else empty


def replay(listings: DataFrame, runs: DataFrame, rows_per_bucket: int = 200_000) -> DataFrame:
    """Every lease of every item: ``doc_id, version, run_no, token, state, out_path`` with state ``done`` or ``expired``.

    ``listings``: ``doc_id, file_hash, arrived_at, error``; ``runs``: ``run_no, started_at, status`` and, where there is one, ``finished_at``. An
    item is a document in the version (``file_hash``) of its latest readable listing (``error`` null) that had arrived before a run started.
    The verbs are those of ``run_events``. ``out_path`` depends on item and version only, so a retry ends at the same place.

    Defined cases: of listings with one ``arrived_at`` the largest hash counts, null being the smallest; a null hash is a version
    like any other; null ``doc_id``, ``arrived_at``, ``run_no`` or ``started_at`` give no item or run; repeated rows count once; a run
    listed more than once counts by its earliest start, and as ok if any of its rows is; runs that start together follow
    ``run_no``. An empty table of listings or runs gives an empty result. Listings are reduced to one row for a document and run before
    they are shuffled, so a document may hold any share of them. The runs are held by the driver: at most ``MAX_RUNS``, which is checked.
    """
    end = "unix_micros(finished_at)" if "finished_at" in runs.columns else "cast(null as bigint)"
    usable = runs.where("started_at is not null and run_no is not null")
    one = usable.groupBy("run_no").agg(F.min(F.unix_micros("started_at")).alias("s"), F.max(F.expr(end)).alias("e"),
        F.max_by("status", F.expr("coalesce(status, '') = 'ok'")).alias("status"))
    got = [(r.run_no, r.s, r.e, r.status) for r in one.limit(MAX_RUNS + 1).collect()]
    if len(got) > MAX_RUNS:
        raise ValueError(f"more than {MAX_RUNS} runs")
    events = run_events(got)
    order = sorted(got, key=lambda r: (r[1], r[0]))
    starts = np.array([r[1] for r in order], dtype=np.int64)
    numbers = np.array([r[0] for r in order], dtype=np.int64)

    @F.pandas_udf("int")
    def first_run(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, at.to_numpy(), side="right").astype("int32"))

    seen = listings.where("error is null and doc_id is not null and arrived_at is not null").select("doc_id", "file_hash",
        F.unix_micros("arrived_at").alias("at"))
    placed = seen.withColumn("slot", first_run("at")).where(F.col("slot") < len(starts))
    latest = placed.groupBy("doc_id", "slot").agg(F.max(F.struct("at", "file_hash")).getField("file_hash").alias("version"))
    buckets = max(1, math.ceil(listings.count() / rows_per_bucket))
    kind = dict(listings.dtypes)["doc_id"]

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        item, names = pd.factorize(pdf["doc_id"])
        code, texts = pd.factorize(pdf["version"], use_na_sentinel=False)
        i, v, slot, token, ok = work_through(item, pdf["slot"].to_numpy(), code, events)
        return pd.DataFrame({"doc_id": names[i], "version": texts[v], "run_no": numbers[slot].astype("int32"), "token": token.astype("int32"),
            "ok": ok})

    bucketed = latest.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    walked = bucketed.groupBy("bucket").applyInPandas(walk, f"doc_id {kind}, version string, run_no int, token int, ok boolean")
    path = F.concat(F.lit("out/"), F.substring(F.sha2(F.concat_ws("\x00", F.col("doc_id").cast("string"), F.coalesce("version", F.lit("\x01"))), 256),
        1, 16))
    return walked.select("doc_id", "version", "run_no", "token", F.when(F.col("ok"), "done").otherwise("expired").alias("state"),
        path.alias("out_path"))


def new_or_changed(listings: DataFrame, runs: DataFrame) -> DataFrame:
    """``run_no, doc_id``: for each run the documents whose leases it committed, being new or changed since the last ok run."""
    return replay(listings, runs).where("state = 'done'").select("run_no", "doc_id")


class Conflict(RuntimeError):
    """Another driver wrote the ledger's next generation first; nothing of this verb is in force."""


class Ledger:
    """A durable ledger below ``root``, on any Hadoop file system; only the driver calls it, all item work happens in DataFrames.

    ``log/<n>`` names generation ``n``: it is created without overwriting, which is the compare-and-set between drivers, and only after
    the generation's rows are written whole. A generation holds the items it changed; every ``COMPACT`` generations one holds all. A verb
    that loses the race raises ``Conflict`` and may be called again.
    """

    COMPACT = 16

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path("log"))

    def _path(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}" if below else self.root)

    def _log(self) -> list[tuple[int, list[str]]]:
        """Generations in order, each with the words of its entry: data folder, ``full`` or ``delta``, and for commits from and to."""
        out = []
        for s in self._fs.listStatus(self._path("log")):
            name = s.getPath().getName()
            if name.isdigit() and s.getLen():
                stream = self._fs.open(s.getPath())
                out.append((int(name), bytes(stream.readAllBytes()).decode().split("\n")))
                stream.close()
        return sorted(out)

    def items(self) -> DataFrame:
        """The current ledger table: of each item the row of the latest generation that changed it."""
        log = self._log()
        base = max((n for n, e in log if e[1] == "full"), default=0)
        parts = [self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.root}/{e[0]}").withColumn("g", F.lit(n)) for n, e in log if n >= base]
        if not parts:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        names = [c for c in rows.columns if c not in ("item", "g")]
        return rows.groupBy("item").agg(F.max_by(F.struct(*names), "g").alias("x")).select("item", "x.*")

    def _write(self, at: int, changed: DataFrame, move: tuple[str, str] | None = None) -> None:
        """Generation ``at + 1`` with the changed items, if no other driver has made it."""
        n = at + 1
        full = n % self.COMPACT == 0
        rows = changed.select(*[c.split()[0] for c in LEDGER_SCHEMA.split(", ")])
        if full:
            rows = rows.unionByName(self.items().join(rows.select("item"), "item", "left_anti"))
        data = f"data/{n}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{data}")
        entry = "\n".join([data, "full" if full else "delta", *(move or ())])
        try:
            stream = self._fs.create(self._path(f"log/{n}"), False)
        except Exception as e:  # noqa: BLE001
            self._fs.delete(self._path(data), True)
            raise Conflict(f"generation {n} exists") from e
        stream.write(bytearray(entry.encode()))
        stream.close()

    def _at(self) -> int:
        log = self._log()
        return log[-1][0] if log else 0

    def token(self) -> int:
        """The largest fencing token given so far."""
        return self.items().agg(F.coalesce(F.max("token"), F.lit(0))).first()[0]

    def enqueue(self, listing: DataFrame) -> None:
        """Adds ``item, version`` pairs that are new; an item with another version becomes pending again under it.

        Rows with a null item are left out; of several versions of one item the largest counts; a version already known changes
        nothing, whatever its state. The item keeps its token, so an older writer stays shut out.
        """
        at = self._at()
        fresh = listing.where("item is not null").groupBy("item").agg(F.max("version").alias("new_version"))
        old = self.items().withColumn("known", F.lit(True))
        moved = fresh.join(old, "item", "left").where("known is null or not (new_version <=> version)")
        none = F.lit(None)
        self._write(at, moved.select("item", F.col("new_version").alias("version"), F.lit("pending").alias("state"),
            F.coalesce("token", F.lit(0)).cast("long").alias("token"), none.cast("timestamp").alias("lease_until"),
            none.cast("string").alias("out_path")))

    @staticmethod
    def _over(now: str):
        return F.expr(f"state = 'leased' and lease_until <= timestamp'{now}'")

    def expire(self, now: str) -> None:
        """Leases that ended by ``now`` (a UTC timestamp) return to pending."""
        at = self._at()
        self._write(at, self.items().where(self._over(now)).withColumn("state", F.lit("pending")))

    def lease(self, now: str, until: str, most: int | None = None) -> tuple[int, DataFrame]:
        """Leases pending and expired items until ``until``, the ``most`` first by name if that is given; returns the fencing
        token and the leased items."""
        at = self._at()
        items = self.items()
        token = self.token() + 1
        free = items.where((F.col("state") == "pending") | self._over(now))
        if most is not None:
            free = free.orderBy("item").limit(most)
        self._write(at, free.withColumns({"state": F.lit("leased"), "token": F.lit(token).cast("long"),
            "lease_until": F.expr(f"timestamp'{until}'")}))
        return token, self.items().where((F.col("state") == "leased") & (F.col("token") == token))

    def staging_path(self, token: int) -> str:
        """Where the writer of a token puts its results; no other writer has it."""
        return f"{self.root}/staging/{token}"

    def out_path(self, leased: DataFrame) -> str:
        """The path of a lease's results: a function of its items and versions only, so a retry lands on the same one."""
        digest = leased.agg(F.bit_xor(F.xxhash64("item", "version")), F.count("*")).first()
        return f"{self.root}/out/{hashlib.sha256(repr(tuple(digest)).encode()).hexdigest()[:16]}"

    def commit(self, token: int, leased: DataFrame, now: str | None = None) -> int:
        """Marks the leased items as done and moves their staged results to ``out_path``; returns how many items.

        0: the writer is stale, and nothing changed. That is so if any item of the lease is no longer leased under ``token``, or its lease had
        ended by ``now``. ``leased`` are the rows that ``lease`` returned, made durable by the caller or read anew; the move is part of
        the log, and ``recover`` completes it after a crash.
        """
        at = self._at()
        when = now or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%d %H:%M:%S")
        want = leased.select("item", "version")
        held = self.items().where((F.col("state") == "leased") & (F.col("token") == token)).where(~self._over(when))
        mine = held.join(want, ["item", "version"], "left_semi")
        n = mine.count()
        if not n or n != want.count():
            return 0
        out = self.out_path(want)
        self._write(at, mine.withColumns({"state": F.lit("done"), "out_path": F.lit(out)}), (self.staging_path(token), out))
        self.recover()
        return n

    def recover(self) -> int:
        """Completes the moves of committed results; returns how many were open. Results of rejected writers stay in staging."""
        done = 0
        for _, entry in self._log():
            if len(entry) == 4:
                source, target = (self._jvm.org.apache.hadoop.fs.Path(p) for p in entry[2:])
                if self._fs.exists(source):
                    self._fs.mkdirs(target.getParent())
                    self._fs.delete(target, True)
                    self._fs.rename(source, target)
                    done += 1
        return done
