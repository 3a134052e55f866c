"""Near-duplicate vectors by Euclidean p-stable hashing.

Unit vectors are projected on Gaussian directions, shifted and cut into intervals of one width; a bucket of a table is
the label, the dimension and ROWS such interval numbers. Vectors of one label that share a bucket are compared by
cosine in double precision. A pair is compared in every table in which it meets and counted in the first one only,
which each side can tell from the buckets of both, so no list of pairs is made or shuffled.

Equal vectors of one label are one class with a multiplicity. Buckets with one class are dropped before vectors travel.
A bucket with many classes is cut into blocks, and each pair of blocks is a task's group of bounded size; it returns a
number of links and one parent per class, never its pairs. At the threshold two vectors miss all tables with
probability 2e-5; closer ones with less.

Cases: vectors that are null, empty, zero or hold a null or non-finite component, rows without a label and rows
without an id link with nothing; the latter have no component. Vectors of different dimensions do not link. Rows that
repeat an id are vectors of their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echowire.llm.components import connected
from echowire.llm.frames import map_rows, table
from echowire.llm.pairing import block_pairs, groups
from echowire.llm.shingles import mixed
from echowire.session import stored

COSINE = 0.98
TABLES = 28
ROWS = 8
WIDTH = 1.2
BLOCK = 512
SEED = 20240229

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _projection(dimension: int) -> tuple[np.ndarray, np.ndarray]:
    made = np.random.default_rng([SEED, dimension])
    return made.standard_normal((dimension, TABLES * ROWS)), made.uniform(0, WIDTH, TABLES * ROWS)


def buckets(units: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Bucket keys (rows x TABLES) of unit vectors of one dimension."""
    directions, shift = _projection(units.shape[1])
    cells = np.floor((units @ directions + shift) / WIDTH).astype(np.int64).reshape(len(units), TABLES, ROWS)
    key = np.arange(TABLES, dtype=np.uint64)[None, :] * _STEP + labels.astype(np.int64).view(np.uint64)[:, None]
    key = mixed(key * _STEP + np.uint64(units.shape[1]))
    for i in range(ROWS):
        key = mixed(key * _STEP + cells[:, :, i].view(np.uint64))
    return key.view(np.int64)


def _usable(vector: list | None) -> np.ndarray | None:
    if not vector or None in vector:
        return None
    x = np.array(vector, dtype=np.float64)
    if not np.isfinite(x).all() or not x.any():
        return None
    return x


def _unit(rows: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(r) for r in rows])
    x = x / np.abs(x).max(1, keepdims=True)  # keeps very small and very large values apart from under- and overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _digested(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vector (doubles as bytes) and its hash; both null for a vector that cannot link."""

    def make():
        def run(batch: pa.RecordBatch) -> list:
            labels = batch.column("label").to_pylist()
            held = []
            for label, vec, i in zip(labels, batch.column("embedding").to_pylist(), batch.column("vec_id").to_pylist()):
                x = None if label is None or i is None else _usable(vec)
                held.append(None if x is None else (x + 0.0).tobytes())
            hashes = [None if h is None else xxhash.xxh3_128_digest(h) for h in held]
            return [batch.column("vec_id"), batch.column("label"), hashes, held]

        return run

    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>"))
    return map_rows(rows, "vec_id long, label long, hash binary, vector binary", make)


def _bucket_rows(classes: DataFrame) -> DataFrame:
    """id and keys (one per table) of each class."""

    def make():
        def run(batch: pa.RecordBatch) -> list:
            vectors = batch.column("vector").to_pylist()
            labels = batch.column("label").to_numpy()
            keys: list = [None] * len(vectors)
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for i, row in zip(at, buckets(_unit([vectors[i] for i in at]), labels[at])):
                    keys[i] = row
            return [batch.column("id"), keys]

        return run

    return map_rows(classes.select("id", "label", "vector"), "id long, keys array<long>", make)


def _local_parents(ids: np.ndarray, firsts: np.ndarray, seconds: np.ndarray) -> np.ndarray:
    """The smallest id reachable within the group."""
    low = ids.copy()
    while True:
        before = low.copy()
        np.minimum.at(low, firsts, before[seconds])
        np.minimum.at(low, seconds, before[firsts])
        if (low == before).all():
            return low


def _compared(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("parent", pa.int64())])
    for group in groups(batches, ["key", "left", "right"]):
        ids, copies, block = (group[c].to_numpy() for c in ("id", "copies", "block"))
        split = group["left"][0].as_py() != group["right"][0].as_py()
        units = _unit(group["vector"].to_pylist())
        keys = np.stack([np.asarray(k) for k in group["keys"].to_pylist()])
        at = group["at"][0].as_py()
        firsts, seconds = [], []
        for start in range(0, len(ids), 64):
            near = units[start : start + 64] @ units.T >= cosine
            rows = np.arange(start, min(start + 64, len(ids)))
            if split:
                near &= block[rows][:, None] < block[None, :]
            else:
                near &= rows[:, None] < np.arange(len(ids))[None, :]
            i, j = np.nonzero(near)
            i = i + start
            new = (keys[i, :at] != keys[j, :at]).all(1)
            firsts.append(i[new])
            seconds.append(j[new])
        i, j = np.concatenate(firsts), np.concatenate(seconds)
        if not len(i):
            continue
        links = np.zeros(len(ids), dtype=np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        parent = _local_parents(ids, i, j)
        told = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(x[told]) for x in (ids, links, parent)], schema=schema)


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of vec_id, embedding and label.

    The tables are tuned to cosines from 0.98 on; a lower threshold finds fewer of its links.
    """
    rows = stored(_digested(vectors), "vectors")
    classes = stored(
        rows.where("hash IS NOT NULL").groupBy("label", "hash")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector")), "vector-classes",
    )
    keyed = stored(_bucket_rows(classes), "buckets")
    single = keyed.select("id", F.posexplode("keys").alias("at", "key"))
    heads = single.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = single.join(heads, "key")
    held = classes.select("id", "copies", "vector").join(keyed, "id")
    keys = ["key", "left", "right"]
    blocks = block_pairs(shared, "n", "id", BLOCK).join(held, "id")
    blocks = blocks.select(*keys, "block", "at", "id", "copies", "vector", "keys")
    blocks = blocks.repartition(*keys).sortWithinPartitions(*keys, "block", "id")
    found = blocks.mapInArrow(lambda batches: _compared(batches, cosine), "id long, links long, parent long")
    found = stored(found, "vector-links")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    component = connected(found.where("id <> parent").select(F.col("id").alias("src"), F.col("parent").alias("dst")))
    of_class = classes.join(links, "id", "left").join(component, "id", "left").select(
        "label", "hash", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component"),
    )
    of_row = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return rows.drop("vector").join(of_class, ["label", "hash"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), of_row.alias("component_id"),
        F.coalesce(of_row == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


def op1_pstable_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
