"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "echowire", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="echowire-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a session on a `local` master may leave it unset: its driver and tasks are one process
    and share a temporary folder. On any other master that raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        return _local_folder()
    raise ValueError(f"spark.checkpoint.dir must name a folder shared by all executors (master {master})")


_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it is removed when the driver's process ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_remove_all)
    _written.append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at `path`, in whichever store it names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete what was written below `path`, a scratch path that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    if path in _written:
        _written.remove(path)


def _remove_all() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        for path in list(_written):
            remove_scratch(spark, path)


#: Rows that Spark sends to a Python worker at once, so that a batch of long texts stays small in memory.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS rows; a lower setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once below the shared folder and read back: it cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
