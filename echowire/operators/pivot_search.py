"""Exact search for similar vectors that leaves out whole blocks by the triangle inequality.

Angles between vectors are a metric. A few approved vectors, far from each other, are pivots; every approved vector belongs to
the cell of its nearest pivot, and each cell knows the least and the largest angle of its vectors to every pivot. The
angle of a new vector to any vector of a cell is at least what its own angles lie outside these ranges. A cell for
which that exceeds the angle of the threshold cannot hold a match, and the new vector is not sent there.

The result is that of `similar_pairs`, whatever the pivots; how much is left out depends on the data: much when vectors
lie in groups and the threshold is high, nothing when all angles are alike. `pivot_shares` tells.

Size: pivots come from a sample of at most SAMPLE vectors and are at most PIVOTS for each dimension, so the tables of
pivots and ranges, which are broadcast, have a fixed size. Cells are cut into blocks by a hash of the id, so a cell with a
large part of all vectors is spread.

Cases: vectors that are null, zero, or hold a null or a value that is not finite match nothing. Vectors of a
dimension without a pivot are compared with all of their dimension.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from echowire.functions.numbers import pair_product, pair_sum
from echowire.functions.vectors import lengths_of, matrix_of
from echowire.operators.implied import members_of
from echowire.operators.ratings import HIGH_SIMILARITY
from echowire.operators.similarity import (
    BEST, BLOCK_BYTES, MATCHES, article_pairs, block_best, block_join, block_matches, classed, vector_classes, with_selves,
)
from echowire.operators.skew import attach
from echowire.session import stored

# The task functions travel with their helpers, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIVOTS, SAMPLE = 64, 1024
#: Radians that rounding may add to or take from an angle.
SLACK = 1e-6


def _units(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Dimension, row numbers and unit vectors of the usable rows."""
    lengths = lengths_of(vectors)
    for dimension in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dimension)
        matrix, whole = matrix_of(vectors, rows, dimension)
        with np.errstate(all="ignore"):
            norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
        usable = whole & np.isfinite(norms) & (norms > 0)
        yield dimension, rows[usable], matrix[usable] / norms[usable, None]


def _angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ pivots.T, -1.0, 1.0))


def choose_pivots(classes: DataFrame, count: int = PIVOTS) -> dict[int, np.ndarray]:
    """Unit vectors by dimension, each as far as can be from those before, out of a sample by hash."""
    sample = classes.orderBy(F.xxhash64("id", "load"), "id", "load").limit(SAMPLE).select("vector").toArrow()
    chosen = {}
    for dimension, _, units in _units(sample.column("vector").combine_chunks()):
        picked = [0]
        nearest = _angles(units, units[:1])[:, 0]
        while len(picked) < count and nearest.max() > SLACK:
            picked.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _angles(units, units[picked[-1:]])[:, 0])
        chosen[dimension] = units[picked]
    return chosen


def _cells(pivots: dict[int, np.ndarray]) -> dict[int, int]:
    """The number of the first cell of each dimension; a dimension without pivots is one cell of its negative."""
    starts = np.cumsum([0, *(len(p) for p in pivots.values())]).tolist()
    return dict(zip(pivots, starts))


def _plain(classes: DataFrame) -> DataFrame:
    """Classes with id, load and vector in front and their other columns behind."""
    rest = [c for c in classes.columns if c not in ("id", "load", "vector")]
    return classes.select("id", F.col("load").cast("bigint").alias("load"), "vector", *rest)


def _placed(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Approved classes with usable vectors and their cells."""
    classes = _plain(classes)
    schema = StructType([*classes.schema.fields, *StructType.fromDDL("cell int").fields])
    arrow, first = to_arrow_schema(schema), _cells(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dimension, rows, units in _units(batch.column("vector")):
                cell = np.full(len(rows), -dimension)
                if dimension in pivots:
                    cell = first[dimension] + _angles(units, pivots[dimension]).argmin(axis=1)
                held = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*held.columns, pa.array(cell, pa.int32())], schema=arrow)

    return classes.mapInArrow(run, schema)


def _ranges(placed: DataFrame, pivots: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Least and largest angle of each cell to each pivot of its dimension. Tasks send one row per cell; the driver gets
    at most one per cell and pivot."""
    schema = StructType.fromDDL("cell int, low array<double>, high array<double>")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, np.ndarray] = {}
        high: dict[int, np.ndarray] = {}
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            for dimension, rows, units in _units(batch.column("vector")):
                if dimension not in pivots:
                    continue
                angles = _angles(units, pivots[dimension])
                for cell in np.unique(cells[rows]).tolist():
                    own = angles[cells[rows] == cell]
                    low[cell] = np.minimum(low.get(cell, np.inf), own.min(axis=0))
                    high[cell] = np.maximum(high.get(cell, -np.inf), own.max(axis=0))
        rows_ = [{"cell": c, "low": low[c].tolist(), "high": high[c].tolist()} for c in low]
        yield pa.RecordBatch.from_pylist(rows_, schema=arrow)

    each = placed.select("vector", "cell").mapInArrow(run, schema).select(
        "cell", F.posexplode(F.arrays_zip("low", "high")).alias("pivot", "angle"))
    merged = each.groupBy("cell", "pivot").agg(F.min("angle.low").alias("low"), F.max("angle.high").alias("high"))
    found: dict[int, list] = {}
    for row in merged.orderBy("cell", "pivot").collect():
        found.setdefault(row["cell"], []).append((row["low"], row["high"]))
    return {cell: tuple(np.array(x) for x in zip(*angles)) for cell, angles in found.items()}


def _routed(
    classes: DataFrame, pivots: dict[int, np.ndarray], ranges: dict, sizes: dict[int, int], blocks: dict[int, int], threshold: float
) -> DataFrame:
    """New classes with usable vectors, the cells and blocks they are sent to, and how many approved classes these hold."""
    classes = _plain(classes)
    more = StructType.fromDDL("targets array<struct<cell: int, approvedBlock: int>>, compared bigint")
    schema = StructType([*classes.schema.fields, *more.fields])
    arrow, first = to_arrow_schema(schema), _cells(pivots)
    limit = math.acos(max(-1.0, min(1.0, threshold))) + SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dimension, rows, units in _units(batch.column("vector")):
                if dimension in pivots:
                    own = [c for c in range(first[dimension], first[dimension] + len(pivots[dimension])) if c in ranges]
                    angles = _angles(units, pivots[dimension])
                    near = np.stack([
                        (np.maximum(ranges[c][0] - angles, angles - ranges[c][1]).max(axis=1) <= limit) for c in own
                    ], axis=1) if own else np.zeros((len(rows), 0), dtype=bool)
                else:
                    own = [-dimension] if -dimension in sizes else []
                    near = np.ones((len(rows), len(own)), dtype=bool)
                places = [[{"cell": c, "approvedBlock": b} for b in range(blocks[c])] for c in own]
                targets = [[t for i in np.flatnonzero(row) for t in places[i]] for row in near]
                compared = near @ np.array([sizes[c] for c in own], dtype=np.int64)
                held = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*held.columns, pa.array(targets, arrow.field("targets").type), pa.array(compared, pa.int64())], schema=arrow)

    return classes.mapInArrow(run, schema)


def _search(new: DataFrame, approved: DataFrame, threshold: float, pivots: int, block_rows: int | None) -> tuple[DataFrame, DataFrame]:
    """The routed new classes and the placed approved classes with their blocks, both stored."""
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    chosen = choose_pivots(approved, pivots)
    placed = stored(_placed(approved, chosen), "cells")
    held = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dimension")).collect()
    sizes = {r["cell"]: r["n"] for r in held}
    blocks = {r["cell"]: math.ceil(r["n"] / (block_rows or max(1, BLOCK_BYTES // (8 * r["dimension"])))) for r in held}
    routed = stored(_routed(new, chosen, _ranges(placed, chosen), sizes, blocks, threshold), "routed")
    return routed, placed.withColumn("approvedBlock", F.pmod(F.xxhash64("id"), _by_cell(blocks)).cast("int"))


def _by_cell(numbers: dict[int, int]) -> Column:
    """The number of the row's cell; there are no more cells than pivots and dimensions."""
    return F.create_map(*(F.lit(x) for pair in numbers.items() for x in pair)).cast("map<int,int>")[F.col("cell")]


def _matches(
    new: DataFrame, approved: DataFrame, threshold: float, pivots: int, block_rows: int | None, prepare: Callable, schema: str
) -> DataFrame:
    """`block_join` by `prepare` of the blocks that may hold pairs of classes above the threshold."""
    routed, placed = _search(new, approved, threshold, pivots, block_rows)
    held = [c for c in routed.columns if c not in ("targets", "compared")]
    sent = routed.select(*held, F.explode("targets").alias("to")).select(*held, "to.*")
    # All blocks of a cell get the same new classes, which are cut too, so that more tasks can share a cell.
    most = block_rows or max(1, BLOCK_BYTES // (8 * max(1, routed.agg(F.max(F.size("vector"))).first()[0] or 1)))
    counts = sent.where("approvedBlock = 0").groupBy("cell").count().collect()
    cuts = _by_cell({r["cell"]: math.ceil(r["count"] / most) for r in counts})
    keys = ["cell", "approvedBlock", "newBlock"]
    left = sent.withColumn("newBlock", F.pmod(F.xxhash64("id"), cuts).cast("int"))
    right = placed.where(cuts.isNotNull()).withColumn("newBlock", F.explode(F.sequence(F.lit(0), cuts - 1)))
    return block_join(left, right, keys, prepare, schema)


def pivot_pairs(
    roster: DataFrame, vectors: DataFrame, threshold: float = HIGH_SIMILARITY, pivots: int = PIVOTS, block_rows: int | None = None
) -> DataFrame:
    """The rows of `similar_pairs`, by the search described above; the threshold must not be negative."""
    members = stored(members_of(roster, vectors.select("articleId", "embedding")), "members")
    new, approved = (stored(c, "vector-classes") for c in vector_classes(members))
    new = with_selves(members, new, approved)
    return article_pairs(_matches(new, approved, threshold, pivots, block_rows, block_matches(threshold), MATCHES))


def high_report(
    roster: DataFrame, vectors: DataFrame, threshold: float = HIGH_SIMILARITY, pivots: int = PIVOTS, block_rows: int | None = None
) -> DataFrame:
    """Each new article with a score above the threshold: how many it has (`high`, itself included), the best, and its lowest id.

    These are the columns of `similarity_report` that need no score at or below the threshold.
    """
    members = stored(members_of(roster, vectors.select("articleId", "embedding")), "members")
    new, approved = (stored(c, "vector-classes") for c in vector_classes(members))
    # sums of each block, so that no list of matches is made
    found = _matches(new, approved, threshold, pivots, block_rows, block_best(threshold), BEST)
    figures = found.groupBy(F.col("newClass").alias("classId"), "newLoad").agg(
        F.sum("high").alias("high"),
        F.max(F.struct(F.round("similarity", 12).alias("rank"), (-F.col("approvedClass")).alias("minusId"), "similarity")).alias("top"),
    )
    of_class = classed(members, new, "newLoad").select("articleId", "classId", F.col("newLoad").cast("bigint").alias("newLoad"))
    many = new.select(F.col("id").alias("classId"), F.col("load").cast("bigint").alias("newLoad"), F.col("articles").alias("n"))
    report = attach(of_class, figures.join(many, ["classId", "newLoad"]), ["classId", "newLoad"], ["articleId"], size="n")
    return report.select("articleId", "high", F.col("top.similarity").alias("best"), (-F.col("top.minusId")).alias("bestId"))


def pivot_shares(
    roster: DataFrame, vectors: DataFrame, threshold: float = HIGH_SIMILARITY, pivots: int = PIVOTS, block_rows: int | None = None
) -> DataFrame:
    """class_pairs of usable vectors, how many of them `pivot_pairs` compares, and the share that it leaves out."""
    members = stored(members_of(roster, vectors.select("articleId", "embedding")), "members")
    new, approved = (stored(c, "vector-classes") for c in vector_classes(members))
    routed, placed = _search(new, approved, threshold, pivots, block_rows)
    row = routed.agg(F.count("*").alias("n"), pair_sum(F.col("compared")).alias("compared")).crossJoin(
        F.broadcast(placed.agg(F.count("*").alias("m"))))
    pairs = pair_product(F.col("n"), F.col("m"))
    return row.select(
        pairs.alias("class_pairs"), "compared",
        F.when(pairs > 0, 1 - F.col("compared").cast("double") / pairs.cast("double")).otherwise(0.0).alias("share_left_out"),
    )
