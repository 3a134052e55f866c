"""The intake log: which article ids were loaded as new or approved, and in which load.

A load pairs every new id it lists with every article approved by then. The log keeps the two
lists, one row per id and load, instead of their product: it grows with the articles, not
with the pairs. Loads are numbered upwards and each is a partition of its own, so a load that
is repeated after a failure replaces what it wrote before. Each number belongs to the writer that
claimed it, by a small file that only one writer can create; no other writer can replace its load.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "articleId bigint, role string, load int"
NEW, APPROVED = "new", "approved"


def read_log(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The log so far, or what it held before a given load; empty if there is none yet."""
    try:
        log = spark.read.schema(LOG).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], LOG)
    return log if before is None else log.where(F.col("load") < before)


def load_rows(log: DataFrame, new_ids: DataFrame, approved_ids: DataFrame, load: int) -> DataFrame:
    """What one load adds: all ids it lists, and the approved ids the log does not hold yet."""
    listed = new_ids.select("articleId").distinct()
    held = log.where(F.col("role") == APPROVED).select("articleId")
    approved = approved_ids.select("articleId").distinct().join(held, "articleId", "left_anti")
    return listed.withColumn("role", F.lit(NEW)).unionByName(
        approved.withColumn("role", F.lit(APPROVED))
    ).withColumn("load", F.lit(load))


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _claims(spark: SparkSession, path: str) -> dict[int, str]:
    """Who claimed which load."""
    files, claims = _folder(spark, f"{path}/_claims")
    if not files.exists(claims) or not files.listStatus(claims):
        return {}
    rows = spark.read.text(f"{path}/_claims", wholetext=True).select("value", "_metadata.file_name").collect()
    return {int(r["file_name"]): r["value"] for r in rows}


def _claim(spark: SparkSession, path: str, load: int, owner: str) -> bool:
    """Create the claim file of a load; False if somebody has."""
    files, claim = _folder(spark, f"{path}/_claims/{load}")
    try:
        out = files.create(claim, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.toString() or "already exists" in str(error.java_exception):
            return False
        raise
    out.write(bytearray(owner.encode()))
    out.close()
    return True


def _written_loads(spark: SparkSession, path: str) -> list[int]:
    files, log = _folder(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(log)] if files.exists(log) else []
    return [int(n.removeprefix("load=")) for n in names if n.startswith("load=")]


def claim_load(spark: SparkSession, path: str, writer: str, step: int) -> int:
    """The load number of one step of a writer: the one it claimed before, or the next free one."""
    owner = f"{writer} {step}"
    while True:
        claims = _claims(spark, path)
        held = [load for load, who in claims.items() if who == owner]
        if held:
            return held[0]
        load = max([-1, *claims, *_written_loads(spark, path)]) + 1
        if _claim(spark, path, load, owner):
            return load


def write_load(
    spark: SparkSession, path: str, new_ids: DataFrame, approved_ids: DataFrame, load: int, writer: str = "manual"
) -> None:
    """Write one load. A writer may repeat its own load; one that belongs to another writer is an error."""
    owner = _claims(spark, path).get(load)
    if owner is None:
        if load in _written_loads(spark, path) or not _claim(spark, path, load, writer):
            raise ValueError(f"load {load} exists and belongs to another writer")
    elif owner != writer and not owner.startswith(f"{writer} "):
        raise ValueError(f"load {load} belongs to another writer")
    rows = load_rows(read_log(spark, path, before=load), new_ids, approved_ids, load)
    rows.drop("load").write.mode("overwrite").parquet(f"{path}/load={load}")


def roster(log: DataFrame) -> DataFrame:
    """One row per article: the last load that listed it and the first that found it approved.

    The pair (n, a) exists exactly when a.approvedLoad <= n.newLoad.
    """
    return log.groupBy("articleId").agg(
        F.max(F.when(F.col("role") == NEW, F.col("load"))).alias("newLoad"),
        F.min(F.when(F.col("role") == APPROVED, F.col("load"))).alias("approvedLoad"),
    )
