"""Id files that arrive in a folder become loads of the intake log.

The stream delivers the paths of new files. Each micro-batch reads its files by their headers and becomes one load, whose
number is claimed for the stream and the batch: a batch that is replayed after a failure finds its claim and replaces
its own load, and another stream or a new checkpoint gets numbers of its own. Lines that are no ids and ids without an
article are kept in a table next to the log.
"""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from echowire.sources.id_files import distinct_ids, known_ids, read_id_file, rejected_lines, unknown_ids
from echowire.sources.intake_log import claim_load, write_load
from echowire.sources.tables import approved_ids

REJECTS = "rawId string, reason string, load int"
_FILE = "path string, modificationTime timestamp, length bigint, content binary"  # as the source demands
MALFORMED, UNKNOWN = "malformed", "unknown"


def rejects_path(log_path: str) -> str:
    return f"{log_path.rstrip('/')}-rejects"


def read_rejects(spark: SparkSession, log_path: str) -> DataFrame:
    """Malformed lines and unknown ids of all streamed loads: rawId, reason, load."""
    try:
        return spark.read.schema(REJECTS).parquet(rejects_path(log_path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REJECTS)


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """The column names of each file, from the first line of its first split."""
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    first = lines.where("file_block_start = 0").groupBy("file_path").agg(F.first("value").alias("line"))
    return {r["file_path"]: tuple(next(csv.reader([r["line"]]), ())) for r in first.collect()}


def read_id_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The raw ids of files whose columns may differ in order; a file without the id column is an error.

    One read for each distinct header. The lists here hold the files of one load, at most `files_per_load`.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, header in _headers(spark, paths).items():
        by_header.setdefault(header, []).append(path)
    if sum(map(len, by_header.values())) < len(paths):
        raise ValueError("an id file has no header line")
    return reduce(DataFrame.unionAll, (read_id_file(spark, files) for files in by_header.values()))


def intake_query(
    spark: SparkSession,
    folder: str,
    log_path: str,
    checkpoint: str,
    articles: Callable[[], DataFrame],
    approved: Callable[[], DataFrame],
    files_per_load: int = 1000,
    continuous: bool = False,
) -> StreamingQuery:
    """Start reading id files; by default stop once those present are loaded.

    `articles` and `approved` return the current tables and are called for every load. Ids without an article and
    malformed lines go to the rejects. A file without the id column ends the stream with an error; empty files are
    passed over.
    """
    files = (
        spark.readStream.format("binaryFile").schema(_FILE).option("maxFilesPerTrigger", files_per_load).load(folder)
    ).select("path")

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        paths = [r["path"] for r in batch.distinct().collect()]
        if not paths:
            return
        stream = session.read.text(f"{checkpoint}/metadata").first()["value"]
        claimed = claim_load(session, log_path, stream, number)
        lines = read_id_files(session, paths)
        ids, known = distinct_ids(lines), articles()
        rejects = rejected_lines(lines).withColumn("reason", F.lit(MALFORMED)).unionByName(
            unknown_ids(ids, known).select(F.col("articleId").cast("string").alias("rawId"), F.lit(UNKNOWN).alias("reason"))
        )
        rejects.write.mode("overwrite").parquet(f"{rejects_path(log_path)}/load={claimed}")
        write_load(session, log_path, known_ids(ids, known), approved_ids(approved()), claimed, writer=stream)

    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if not continuous:
        writer = writer.trigger(availableNow=True)
    return writer.start()
