"""Comparing many pairs of rows without a hot key and without a product of groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Members that are compared with one copy of their pivot.
MEMBERS = 64


def against_pivots(pairs: DataFrame, values: DataFrame, prepare: Callable, test: Callable) -> DataFrame:
    """The pairs (a, b) for which test(prepare(value of a), prepare(value of b)) holds.

    `values` has id and value. Members of a pivot `a` are salted into groups of about MEMBERS rows and each group gets
    one copy of the pivot's value, so that no pivot fills a partition, whatever its number of members. Groups are
    sorted with the pivot in front and read as a stream.
    """
    pairs = pairs.select("a", "b")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).alias("parts"))
    members = pairs.join(parts, "a").select("a", F.expr("pmod(xxhash64(b), parts)").alias("salt"), "b")
    members = members.join(values.select(F.col("id").alias("b"), "value"), "b").select("a", "salt", "b", "value")
    pivots = parts.select("a", F.explode(F.expr("sequence(0, parts - 1)")).alias("salt"))
    pivots = pivots.join(values.select(F.col("id").alias("a"), "value"), "a")
    pivots = pivots.select("a", "salt", F.lit(None).cast("long").alias("b"), "value")
    rows = members.unionByName(pivots).repartition("a", "salt")
    rows = rows.sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            found = []
            values_ = batch.column("value")
            for i, (a, salt, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "b")))):
                if (a, salt) != group:
                    group, held = (a, salt), []
                value = prepare(values_[i].as_py())
                if b is None:
                    held.append(value)
                elif any(test(x, value) for x in held):
                    found.append((a, b))
            columns = zip(*found) if found else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return rows.mapInArrow(run, "a long, b long")


def block_pairs(rows: DataFrame, size: str, key: str, block_rows: int) -> DataFrame:
    """Each row once for every pair of blocks of its group that it takes part in: columns left, right, block.

    A group of `size` rows is cut by the hash of `key` into blocks of about `block_rows`; a group of one block gives one
    row each. The pairs (left <= right) of blocks hold every pair of rows exactly once.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col(size) / block_rows)).cast("int")
    cut = rows.withColumn("__blocks", blocks).withColumn("block", F.expr(f"cast(pmod(xxhash64({key}), __blocks) as int)"))
    cut = cut.withColumn("__other", F.explode(F.expr("sequence(0, __blocks - 1)")))
    return cut.withColumns({
        "left": F.least("block", "__other"), "right": F.greatest("block", "__other"),
    }).drop("__blocks", "__other")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys as one table each. Groups must be of bounded size."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        marks = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        start = 0
        for i, mark in enumerate(marks):
            if mark != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, mark
        if len(marks) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
