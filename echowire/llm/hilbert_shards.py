"""Shards along a Hilbert curve, cut into runs of equal row counts.

Each document is a point in a grid of quantised metadata (size class, language, source). Rows are range-partitioned
and sorted by the curve index of that point, so that a run of rows covers few values of every dimension and files
can be pruned on any of them. Global ranks come from the row counts of the sorted partitions; runs of ranks are shards.

Law: `rows`, shard sizes differ by one row at most. Documents with equal text take the place of the first of them
on the curve, so they follow each other and a cut divides them only where the law demands it.

Cases: a null text has size 8 and checksum 0, null metadata is a value of its own, an empty table gives no rows.
Repeated rows are rows of their own. Only ids, sizes and hashes are shuffled, never texts.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echowire.llm.frames import table
from echowire.session import stored

SHARDS = 24
#: Bits of each dimension of the grid.
BITS = 6
#: Bytes that each row counts besides its text.
ROW_BYTES = 8


def curve_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of `points` (rows x dimensions, values below 2**bits)."""
    axes = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    bit = 1 << (bits - 1)
    while bit > 1:  # undo the rotations and reflections of each level
        low = bit - 1
        for i in range(len(axes)):
            flip = (axes[i] & bit) != 0
            swap = np.where(flip, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = axes[0] ^ np.where(flip, low, swap)
            if i:
                axes[i] = axes[i] ^ swap
        bit >>= 1
    for i in range(1, len(axes)):  # Gray code
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn = turn ^ np.where((axes[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    index = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            index = (index << 1) | (((axis ^ turn) >> level) & 1)
    return index


def quantised(size: str, names: Sequence[str], bits: int) -> list[Column]:
    """Grid values: twice the binary logarithm of the size, and the name columns by checksum."""
    top = (1 << bits) - 1
    by_size = F.least(F.lit(top), F.floor(2 * F.log2(F.col(size))).cast("int"))
    return [by_size, *(F.pmod(F.crc32(F.coalesce(F.col(n).cast("string"), F.lit("\u0000"))), top + 1).cast("int") for n in names)]


def curve_column(dimensions: list[Column], bits: int) -> Column:
    @F.pandas_udf("long")
    def index(points: pd.DataFrame) -> pd.Series:
        return pd.Series(curve_index(points.to_numpy(), bits))

    return index(F.struct(*(d.alias(f"d{i}") for i, d in enumerate(dimensions))))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """`rows` with their gapless position (`rank`, from 0) in the order, and the row count (`total`).

    A range shuffle and a sort in each partition; the position in the partition is added to the number of rows in
    the partitions before it. The broadcast table has one row per partition.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(Window.partitionBy()).alias("total"),
    )
    return (
        placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
        .withColumn("rank", F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1))
        .drop("__part", "__at", "__before")
    )


def shard_rows(docs: DataFrame, shards: int = SHARDS, names: Sequence[str] = ("lang", "source"), bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard and slot of each document, sorted along the curve."""
    text = F.coalesce("text", F.lit(""))
    points = [f"__p{i}" for i in range(len(names) + 1)]
    rows = docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("__text"), *names,
    )
    rows = stored(rows.select(
        "doc_id", "size", "text_crc32", "__text",
        *(q.alias(p) for q, p in zip(quantised("size", names, bits), points)),
    ), "points")
    same = ["__text", "text_crc32", "size"]
    firsts = rows.groupBy(*same).agg(F.min(F.struct("doc_id", *points)).alias("__first"))
    firsts = firsts.select(*same, curve_column([F.col(f"__first.{p}") for p in points], bits).alias("curve"))
    placed = ranked(rows.drop(*points).join(firsts, same), ["curve", *same, "doc_id"])
    shard = F.expr(f"((rank + 1) * {shards} - 1) div total")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", "curve", "shard",
        F.expr(f"rank - (shard * total) div {shards}").cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """The documents below `path`, a folder for each shard, rows of each file in slot order. doc_id must be unique."""
    placed = docs.join(assigned.select("doc_id", F.col("shard").alias("__shard"), F.col("slot").alias("__slot")), "doc_id")
    sorted_rows = placed.repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot")
    sorted_rows.drop("__slot").withColumnRenamed("__shard", "shard").write.partitionBy("shard").parquet(path)


def op10_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )
