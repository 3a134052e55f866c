"""Cosine similarity on the pairs a roster implies.

Every pair has a score of its own, so the arithmetic is that of all pairs. Both lists are cut
into blocks of bounded size and each pair of blocks is one matrix product in one task. The report
returns one row of sums per new article and writes no pair; the list of similar pairs holds equal
vectors as one class, so its size is that of the matches between different vectors. Blocks are cut by
a hash of the id, so neither copies of a vector nor a crowded region of space make one larger. Their
number follows from the bytes of the vectors, and is at least such that all task slots have work.

A task holds one block of approved vectors. New vectors pass it as a stream, and what they give is sent on piece by
piece, so memory depends neither on the number of matches nor on how many vectors the other side has.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echowire.functions.numbers import pair_product, pair_sum
from echowire.functions.vectors import lengths_of, matrix_of
from echowire.operators.figures import embedding_percentages, one_row
from echowire.operators.implied import members_of, pair_count
from echowire.operators.ratings import HIGH_SIMILARITY
from echowire.operators.skew import attach
from echowire.session import stored

# The task function travels with its helpers, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 64 << 20  # of vectors as doubles; each is sent once per block of the other side
LEAST_ROWS = 128  # of a block, however many task slots there are
_CELLS = 1 << 21  # scores, and so matches, held at once inside a task

_SUMS = (
    "articleId bigint, compared bigint, failed bigint, high bigint, total double, "
    "best double, bestId bigint"
)


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _unit_vectors(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors by dimension; rows without a usable vector are left out."""
    vectors = table.column("vector").combine_chunks()
    lengths = lengths_of(vectors)
    groups = {}
    for dimension in np.unique(lengths[lengths >= 0]).tolist():
        rows = np.flatnonzero(lengths == dimension)
        matrix, whole = matrix_of(vectors, rows, dimension)
        rows, matrix = rows[whole], matrix[whole]
        with np.errstate(invalid="ignore", over="ignore"):
            norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
            matrix = matrix / np.where(norms == 0, 1.0, norms)[:, None]
        groups[dimension] = (rows, matrix)
    return groups


def _block_sums(threshold: float, exclude_self: bool):
    def prepare(approved: pa.Table):
        approved = approved.sort_by("id")  # the first of equal scores has the lowest id
        approved_ids, approved_loads = _ints(approved, "id"), _ints(approved, "load")
        sorted_loads = np.sort(approved_loads)
        targets = _unit_vectors(approved)

        def sums(new: pa.Table) -> Iterator[pa.Table]:
            new_ids, new_loads = _ints(new, "id"), _ints(new, "load")
            count = len(new_ids)
            compared = np.searchsorted(sorted_loads, new_loads, side="right")
            if exclude_self and len(approved_ids):
                at = np.minimum(np.searchsorted(approved_ids, new_ids), len(approved_ids) - 1)
                compared = compared - ((approved_ids[at] == new_ids) & (approved_loads[at] <= new_loads))
            scored, high, total = np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count)
            best, best_id = np.full(count, -1.0), np.zeros(count, np.int64)

            for dimension, (rows, matrix) in _unit_vectors(new).items():
                if dimension not in targets:
                    continue
                columns, others = targets[dimension]
                ids, loads = approved_ids[columns], approved_loads[columns]
                step = max(1, _CELLS // max(1, len(columns)))
                for start in range(0, len(rows), step):
                    part = rows[start : start + step]
                    with np.errstate(invalid="ignore"):
                        scores = matrix[start : start + step] @ others.T
                        scores = np.where(scores > 0, scores, 0.0)
                    paired = loads[None, :] <= new_loads[part, None]
                    if exclude_self:
                        paired &= ids[None, :] != new_ids[part, None]
                    scores = np.where(paired, scores, -1.0)
                    scored[part] = paired.sum(axis=1)
                    high[part] = (scores > threshold).sum(axis=1)
                    total[part] = np.where(paired, scores, 0.0).sum(axis=1)
                    if len(columns):
                        # copies of one vector differ in the last bits only; they shall tie
                        top = np.round(scores, 12).argmax(axis=1)
                        best[part] = scores[np.arange(len(part)), top]
                        best_id[part] = ids[top]
            none = best < 0
            yield pa.table({
                "articleId": pa.array(new_ids, pa.int64()),
                "compared": pa.array(compared, pa.int64()),
                "failed": pa.array(compared - scored, pa.int64()),
                "high": pa.array(high, pa.int64()),
                "total": pa.array(total, pa.float64()),
                "best": pa.array(best, pa.float64(), mask=none),
                "bestId": pa.array(best_id, pa.int64(), mask=none),
            })

        return sums

    return prepare


def block_join(new: DataFrame, approved: DataFrame, keys: list[str], prepare: Callable, schema: str) -> DataFrame:
    """The results of all groups of two tables with equal `keys`, whose other columns have the same types.

    `prepare` gets the approved rows of a group, which must be of bounded size, and returns a function that
    yields tables for any part of its new rows. The new rows are never held together.
    """
    sides = approved.withColumn("__new", F.lit(False)).unionByName(new.withColumn("__new", F.lit(True)), allowMissingColumns=True)
    rows = sides.repartition(*keys).sortWithinPartitions(*keys, "__new")
    marks = [*keys, "__new"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, compare = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in marks]
            ends = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for start, end in zip([0, *ends.tolist()], [*ends.tolist(), batch.num_rows]):
                part = batch.slice(start, end - start)
                if (mark := tuple(c[start] for c in columns[:-1])) != group:
                    group, held, compare = mark, [], None
                if not columns[-1][start]:
                    held.append(part)
                    continue
                if compare is None:
                    compare, held = prepare(pa.Table.from_batches(held, schema=batch.schema)), []
                for found in compare(pa.Table.from_batches([part])):
                    yield from found.to_batches()

    return rows.mapInArrow(run, schema)


def _blockwise(new: DataFrame, approved: DataFrame, blocks: tuple[int, int], prepare: Callable, schema: str) -> DataFrame:
    """`prepare` on every pair of blocks of two tables of id, load, vector and further columns."""
    keys = ["newBlock", "approvedBlock"]

    def cut(rows: DataFrame, own: int) -> DataFrame:
        return rows.select(
            "*",
            F.pmod(F.xxhash64("id"), F.lit(blocks[own])).cast("int").alias(keys[own]),
            F.explode(F.sequence(F.lit(0), F.lit(blocks[1 - own] - 1))).alias(keys[1 - own]),
        )

    return block_join(cut(new, 0), cut(approved, 1), keys, prepare, schema)


def _block_counts(members: DataFrame, block_rows: int | None) -> tuple[int, int]:
    """Into how many blocks to cut new and approved members, a stored table."""
    *sizes, dimension = members.agg(
        F.count("newLoad"), F.count("approvedLoad"), F.max(F.size("embedding"))
    ).first()
    most = block_rows or max(LEAST_ROWS, BLOCK_BYTES // (8 * max(1, dimension or 1)))
    slots = members.sparkSession.sparkContext.defaultParallelism
    spread = math.ceil(math.sqrt(2 * slots))
    return tuple(
        max(1, math.ceil(n / most), min(spread, math.ceil(n / LEAST_ROWS)) if not block_rows else 1) for n in sizes
    )


def similarity_report(
    roster: DataFrame,
    vectors: DataFrame,
    threshold: float = HIGH_SIMILARITY,
    exclude_self: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """Each new article with a vector row: how many approved articles it was compared with,
    failures, scores above the threshold, the sum of scores, and its best match.

    Failures are pairs whose vectors are missing or differ in dimension; they count as
    compared with score 0.0. `vectors` has one row per article.
    """
    members = stored(members_of(roster, vectors.select("articleId", "embedding")), "members")
    blocks = _block_counts(members, block_rows)
    sides = [
        members.where(F.col(load).isNotNull()).select(
            F.col("articleId").alias("id"), F.col(load).alias("load"), F.col("embedding").alias("vector")
        ) for load in ("newLoad", "approvedLoad")
    ]
    sums = _blockwise(*sides, blocks, _block_sums(threshold, exclude_self), _SUMS)
    best = F.max(F.struct(
        F.round("best", 12).alias("rank"), (-F.col("bestId")).alias("minusId"), "best"
    ))
    merged = sums.groupBy("articleId").agg(
        *(F.sum(c).alias(c) for c in ("compared", "failed", "high", "total")),
        best.alias("top"),
    )
    return merged.select(
        "articleId", "compared", "failed", "high", "total",
        F.col("top.best").alias("best"), (-F.col("top.minusId")).alias("bestId"),
    )


MATCHES = (
    "newClass bigint, newLoad bigint, approvedClass bigint, approvedLoad bigint, similarity double, "
    "newArticles bigint, approvedArticles bigint, selves bigint"
)
BEST = "newClass bigint, newLoad bigint, high bigint, similarity double, approvedClass bigint"


def _above(new: pa.Table, loads: np.ndarray, targets: dict, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers of new and approved classes that score above the threshold, by new row, and their scores."""
    new_loads = _ints(new, "load")
    for dimension, (rows, matrix) in _unit_vectors(new).items():
        if dimension not in targets:
            continue
        columns, others = targets[dimension]
        step = max(1, _CELLS // max(1, len(columns)))
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            with np.errstate(invalid="ignore"):
                scores = matrix[start : start + step] @ others.T
                high = (scores > threshold) & (loads[columns][None, :] <= new_loads[part, None])
            i, j = np.nonzero(high)
            if len(i):
                yield part[i], columns[j], scores[i, j]


def block_matches(threshold: float):
    """For `block_join`: all matches of new with approved classes, as MATCHES."""
    names = [field.split()[0] for field in MATCHES.split(", ")]

    def prepare(approved: pa.Table):
        approved_ids, approved_loads, approved_articles = (_ints(approved, c) for c in ("id", "load", "articles"))
        targets = _unit_vectors(approved)

        def matches(new: pa.Table) -> Iterator[pa.Table]:
            new_ids, new_loads, new_articles = (_ints(new, c) for c in ("id", "load", "articles"))
            entries = pc.list_flatten(new["own"]).combine_chunks()
            own_ids, own_loads, own_selves = (
                pc.struct_field(entries, c).to_numpy(zero_copy_only=False) for c in ("approvedClass", "approvedLoad", "selves"))
            own = pc.fill_null(pc.list_value_length(new["own"]), 0).to_numpy()
            first = np.cumsum(own) - own
            for i, j, scores in _above(new, approved_loads, targets, threshold):
                ids, loads = approved_ids[j], approved_loads[j]
                selves = np.zeros(len(i), np.int64)
                for k in range(int(own[i].max())):
                    some = np.flatnonzero(own[i] > k)
                    at = first[i[some]] + k
                    same = (own_ids[at] == ids[some]) & (own_loads[at] == loads[some])
                    selves[some[same]] = own_selves[at[same]]
                columns = (new_ids[i], new_loads[i], ids, loads, scores, new_articles[i], approved_articles[j], selves)
                yield pa.table([pa.array(c, pa.float64() if c is scores else pa.int64()) for c in columns], names=names)

        return matches

    return prepare


def block_best(threshold: float):
    """For `block_join`: of each new class with matches the number of matching articles and the best match, as BEST."""
    names = [field.split()[0] for field in BEST.split(", ")]

    def prepare(approved: pa.Table):
        approved_ids, approved_loads, approved_articles = (_ints(approved, c) for c in ("id", "load", "articles"))
        targets = _unit_vectors(approved)

        def best(new: pa.Table) -> Iterator[pa.Table]:
            new_ids, new_loads = _ints(new, "id"), _ints(new, "load")
            for i, j, scores in _above(new, approved_loads, targets, threshold):
                starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
                high = np.add.reduceat(approved_articles[j], starts)
                # copies of one vector differ in the last bits only; they shall tie
                top = np.lexsort((approved_ids[j], -np.round(scores, 12), i))[starts]
                columns = (new_ids[i[starts]], new_loads[i[starts]], high, scores[top], approved_ids[j][top])
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
                yield pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

        return best

    return prepare


def vector_classes(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of new and of approved members with equal vectors and loads: vector, load, id, articles.

    A class has the lowest id of its articles; pairs exist for all of a class or for none.
    """
    def classes(load: str) -> DataFrame:
        held = members.where(F.col(load).isNotNull() & F.col("embedding").isNotNull())
        return held.groupBy(F.col("embedding").alias("vector"), F.col(load).alias("load")).agg(
            F.min("articleId").alias("id"), F.count("*").alias("articles")
        )

    return classes("newLoad"), classes("approvedLoad")


def class_members(roster: DataFrame, vectors: DataFrame) -> DataFrame:
    """articleId, role, load, classId: which articles a class of `similar_pairs` stands for."""
    members = stored(members_of(roster, vectors.select("articleId", "embedding")), "members")
    sides = [
        classed(members, classes, f"{role}Load").select("articleId", F.lit(role).alias("role"), F.col(f"{role}Load").alias("load"), "classId")
        for role, classes in zip(("new", "approved"), vector_classes(members))
    ]
    return sides[0].unionByName(sides[1])


def classed(members: DataFrame, classes: DataFrame, load: str) -> DataFrame:
    """Members with the given load and the class they belong to; a vector that many share is served by broadcast."""
    keyed = classes.select(F.col("vector").alias("embedding"), F.col("load").alias(load), F.col("id").alias("classId"), "articles")
    return attach(members.where(F.col(load).isNotNull()), keyed, ["embedding", load], ["articleId"], size="articles")


def similar_pairs(
    roster: DataFrame, vectors: DataFrame, threshold: float = HIGH_SIMILARITY, block_rows: int | None = None
) -> DataFrame:
    """All implied pairs of different articles scoring above the threshold, by classes of equal vectors.

    newClass, newLoad, approvedClass, approvedLoad, similarity, and `pairs`, the number of article pairs that the
    row stands for; `class_members` names the articles. Copies of a vector are compared and listed once.
    """
    members = stored(members_of(roster, vectors.select("articleId", "embedding")), "members")
    new, approved = (stored(c, "vector-classes") for c in vector_classes(members))
    new = with_selves(members, new, approved)
    return article_pairs(_blockwise(new, approved, _block_counts(members, block_rows), block_matches(threshold), MATCHES))


def with_selves(members: DataFrame, new: DataFrame, approved: DataFrame) -> DataFrame:
    """New classes with the column `own`, stored: their approved classes of the same vector, and how many articles are in both."""
    # a class holds copies of one vector, so articles in both roles are paired with themselves
    both = members.where("newLoad IS NOT NULL AND approvedLoad <= newLoad AND embedding IS NOT NULL")
    both = both.groupBy(F.col("embedding").alias("vector"), F.col("newLoad").alias("load"), "approvedLoad").agg(F.count("*").alias("selves"))
    named = approved.select("vector", F.col("load").alias("approvedLoad"), F.col("id").alias("approvedClass"))
    entry = F.struct(*(F.col(c).cast("bigint").alias(c) for c in ("approvedClass", "approvedLoad", "selves")))
    own = both.join(named, ["vector", "approvedLoad"]).groupBy("vector", "load").agg(F.collect_list(entry).alias("own"))
    return stored(new.join(own, ["vector", "load"], "left"), "new-classes")


def article_pairs(found: DataFrame) -> DataFrame:
    """Matches of classes with the number of article pairs that each stands for, an article and itself left out."""
    pairs = pair_product(F.col("newArticles"), F.col("approvedArticles")) - F.col("selves")
    counted = found.withColumn("pairs", pairs.cast("decimal(38,0)"))
    return counted.where("pairs > 0").select("newClass", "newLoad", "approvedClass", "approvedLoad", "similarity", "pairs")


def similarity_progress(roster: DataFrame, report: DataFrame) -> DataFrame:
    """Total, completed and pending pairs, high scores, failures and both means.

    `avg_similarity_score` counts a failure as 0.0, `overall_avg_similarity` leaves it out.
    """
    row = one_row(
        pair_count(roster),
        report.agg(
            pair_sum(F.col("compared")).alias("embedding_search_completed"),
            pair_sum(F.col("high")).alias("high_similarity_pairs"),
            pair_sum(F.col("failed")).alias("total_errors"),
            F.coalesce(F.sum("total"), F.lit(0.0)).alias("score_sum"),
        ),
    )
    done = F.col("embedding_search_completed")

    def mean(count):
        return F.when(count > 0, F.col("score_sum") / count.cast("double")).otherwise(0.0)

    return row.select(
        "total_pairs",
        done,
        (F.col("total_pairs") - done).alias("embedding_search_pending"),
        "high_similarity_pairs",
        mean(done).alias("avg_similarity_score"),
        mean(done - F.col("total_errors")).alias("overall_avg_similarity"),
        "total_errors",
    ).withColumns(embedding_percentages())
