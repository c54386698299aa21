"""Session construction, checkpoints and small helpers shared by all operators."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handed to a Python worker at a time; texts run to many kilobytes, so batches stay small.
ARROW_ROWS = 1000


def build_session(app: str = "filanda", cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the operators assume; a cluster brings its own session."""
    return (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def tune(spark: SparkSession) -> None:
    """Bound the Arrow batches of the current session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: spark.checkpoint.dir, or one of our own where it is unset and there is one machine only
    (tests); a cluster must name one."""
    sc = spark.sparkContext
    at = sc.getCheckpointDir()
    if at:
        return at
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        named = tempfile.mkdtemp(prefix="filanda-")
    sc.setCheckpointDir(named)
    return named


_SCRATCH: list[tuple[SparkSession, str]] = []


def cut(df: DataFrame) -> DataFrame:
    """Ends the lineage: the rows as a Parquet table in the shared checkpoint folder, which outlives any executor.

    Unlike ``checkpoint()`` the table is columnar and compressed, and its plan carries no constraints of the
    plans before it, which otherwise grow from round to round. ``drop`` removes it, or the end of the driver.
    """
    spark = df.sparkSession
    at = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(at)
    if not _SCRATCH:
        atexit.register(drop_all)
    _SCRATCH.append((spark, at))
    out = spark.read.schema(df.schema).parquet(at)
    out._filanda_at = at
    return out


def _delete(spark: SparkSession, at: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop(*tables: DataFrame | None) -> None:
    """Removes tables made by ``cut`` that no later plan reads."""
    for t in tables:
        at = getattr(t, "_filanda_at", None)
        for entry in [e for e in _SCRATCH if e[1] == at]:
            _SCRATCH.remove(entry)
            _delete(*entry)


def drop_all() -> None:
    """Removes every table that ``cut`` left; silently, as the session may be gone."""
    while _SCRATCH:
        try:
            _delete(*_SCRATCH.pop())
        except Exception:  # noqa: BLE001
            return


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, so that functions sent to Python workers can be imported there."""
    sc = spark.sparkContext
    if _SHIPPED.get(sc.applicationId):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    at = os.path.join(tempfile.mkdtemp(prefix="filanda-"), "filanda.zip")
    with zipfile.ZipFile(at, "w") as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    p = os.path.join(d, f)
                    z.write(p, os.path.join("filanda", os.path.relpath(p, root)))
    sc.addPyFile(at)
    _SHIPPED[sc.applicationId] = True


_SHIPPED: dict[str, bool] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the named Parquet tables below ``sf_dir``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def hash_bucket(col: Column, n: Column | int) -> Column:
    """Bucket 0..n-1 of a value; nulls share bucket of their hash."""
    return F.pmod(F.xxhash64(col), F.lit(n) if isinstance(n, int) else n)
