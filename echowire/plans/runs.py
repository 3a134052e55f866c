"""A record of each run: what it read, when, and what came out, appended to a table of its own."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echowire.functions.numbers import timestamp_literal

RUNS = "operation string, startedAt timestamp, inputRows bigint, inputHash string, counts map<string,bigint>"


def content_fingerprint(table: DataFrame) -> DataFrame:
    """inputRows and inputHash of a table, whatever the order of its rows.

    The hash is the sum of 60-bit row hashes; a row is hashed with its NULLs and with the names of its columns, in
    alphabetical order.
    """
    cells = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N"))) for c in sorted(table.columns)]
    row = F.conv(F.substring(F.md5(F.concat_ws("\u001f", *cells)), 1, 15), 16, 10).cast("decimal(38,0)")
    return table.agg(
        F.count("*").alias("inputRows"), F.coalesce(F.sum(row), F.lit(0)).cast("decimal(38,0)").cast("string").alias("inputHash")
    )


def run_record(operation: str, read: DataFrame, result: DataFrame, run_ts: datetime) -> DataFrame:
    """One row: the fingerprint of what a run read and the counts of its one-row result."""
    whole = [n for n, kind in result.dtypes if kind in ("bigint", "int") or kind.startswith("decimal")]
    pairs = [x for n in whole for x in (F.lit(n), F.col(n).cast("bigint"))]
    counts = result.select(F.create_map(*pairs).alias("counts")).withColumn("one", F.lit(1))
    row = content_fingerprint(read).withColumn("one", F.lit(1)).join(counts, "one")
    return row.select(
        F.lit(operation).alias("operation"), timestamp_literal(run_ts).alias("startedAt"), "inputRows", "inputHash", "counts"
    )


def append_run(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)
