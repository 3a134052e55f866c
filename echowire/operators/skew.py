"""A join that survives a key shared by a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000


def attach(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    size: str | None = None,
    counted: DataFrame | None = None,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Join each row with the one table row of its key.

    The most frequent keys are served by broadcast, all others by shuffle. The broadcast never
    holds more than `hot_keys` table rows, whatever the input, and a key left to the shuffle
    holds less than one in `hot_keys` of all rows, whatever the skew. Rows served by broadcast
    go through the same shuffle scattered by the columns `spread`, so the plan reads `rows`
    once and has no partition that a single key fills.

    Frequencies come from the column `size` of the table where it has one, else from counting
    the keys of `counted` (by default `rows`). The table must have one row per key, of bounded
    width (hashes, vectors, counts; no text). Rows without a key match nothing and are
    scattered as well.
    """
    keys = list(keys)
    values = [c for c in table.columns if c not in keys]
    if size:
        frequency = table.select(*keys, F.col(size).alias("__n"))
    else:
        frequency = (rows if counted is None else counted).groupBy(*keys).agg(F.count("*").alias("__n"))
    # The same plan on both joins below, so that its broadcast is made once.
    hot = frequency.dropna(subset=keys).orderBy(F.desc("__n"), *keys).limit(hot_keys)
    hot = hot.select(*keys, F.lit(True).alias("__hot"))
    near = table.join(F.broadcast(hot), keys).select(
        *keys, F.when(F.col("__hot"), F.struct(*values)).alias("__near")
    )

    far = table.select(*keys, F.struct(*values).alias("__far"), F.xxhash64(*keys).alias("__slot"))
    # A hot row that meets its far partner after all gets the same values from it.
    no_key = reduce(Column.__or__, (F.col(k).isNull() for k in keys))
    slot = F.when(F.col("__hot") | no_key, F.xxhash64(*spread)).otherwise(F.xxhash64(*keys))
    joined = rows.join(F.broadcast(hot), keys, "left").join(F.broadcast(near), keys, "left")
    joined = joined.withColumn("__slot", slot).join(far, [*keys, "__slot"], "left")
    joined = joined.withColumn("__value", F.coalesce("__near", "__far"))
    if how == "inner":
        joined = joined.where(F.col("__value").isNotNull())
    elif how != "left":
        raise ValueError("how must be 'inner' or 'left'")
    return joined.select(*rows.columns, *(F.col(f"__value.{c}").alias(c) for c in values))
