"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echowire.session import remove_scratch, scratch_path


def connected(edges: DataFrame) -> DataFrame:
    """id and component (smallest id reachable) of every id in an edge (src, dst).

    Large-star and small-star steps alternate until the edges stay the same; each step sends ids towards the smallest
    neighbour, and the number of steps grows with the logarithm of the graph. Minima are aggregated before the
    shuffle, and the edges of each step are written to the shared folder. No neighbour list is gathered.
    Loops and null ends are left out; without edges there are no rows.
    """
    spark = edges.sparkSession
    ordered = edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    (ordered, path), before = _written(ordered.distinct()), None
    while True:
        both = ordered.unionByName(ordered.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, after_path = _written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        if path:
            remove_scratch(spark, path)
        ordered, path = after, after_path
        now = after.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(hash(u, v))")).first()
        if now == before:
            break
        before = now
    members = ordered.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.unionByName(ordered.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _written(edges: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_path(edges.sparkSession, "edges")
    edges.write.parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path), path
