"""Ranked lexical search by pipelined term partitioning.

Documents are cut into shards of bounded size; each shard has an inverted list per term. Terms belong to owners by how
rare they are. Bundles of items carry sparse accumulators (document and score so far) of a shard through the owners,
the rarest terms first: each owner's stage cogroups the bundles with its lists, adds its integer contributions and hands
the bundle on. After the last owner each bundle selects its best documents, and those of all shards are merged.

A bundle drops an accumulator on the way only if all that its item can still gain would not lift it to the
tenth-best score that the bundle holds already, so results are exact.

Size: a cogroup holds the lists of one owner in one shard (at most LISTED entries and a document more) and the
accumulators of the items of one block there. A term has one row per shard, however many documents hold it. Lists are
kept only of terms that fall into a bucket with a term of an item: the filter has 2**20 bits, whatever the items, so it is
broadcast; lists it lets through by chance are dropped when they are joined with the terms.

Cases: null text has no terms and counts nowhere; documents with a null doc_id are ranked and come last among equal scores.
Rows that repeat a doc_id are documents of their own. Rows that repeat an item_id, null included, are one item with the
terms of all of them. Items without terms, and empty tables, give no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from echowire.llm.frames import map_rows, small_batches, table, utf8
from echowire.llm.shingles import LOWER
from echowire.session import scratch_path, stored

#: Documents ranked for each item.
BEST = 10
#: Documents and list entries of a shard; a shard ends with the document that reaches one of them.
SHARD_DOCS, LISTED = 4096, 1 << 20
#: Items whose bundles visit a shard together, on average.
ITEMS = 256
#: Bits of the filter for terms of items.
BUCKETS = 1 << 20
#: An owner has the terms held by at most one document in so many; the last owner has all others.
RARITY = (1000, 100, 10)
#: No term adds more than its weight times this: tf / (1000 tf + 8 m) is below 1/1000.
MOST = 1_000_000
#: Texts of more bytes are counted without listing their terms.
LONG = 1 << 20
#: Terms whose bucket a worker remembers.
MEMORY_TERMS = 500_000

# ASCII digits and letters and all bytes of other signs: as bytes of UTF-8 this is the pattern of whole signs.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def counted(text: bytes) -> Counter:
    """How often each term occurs in a text."""
    text = text.translate(LOWER)
    if len(text) <= LONG:
        return Counter(_TERM.findall(text))
    return Counter(m.group() for m in _TERM.finditer(text))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and term, each once."""

    def run(batch: pa.RecordBatch) -> list:
        lists = [list(counted(t)) for t in utf8(batch, "text")]
        return [batch.column("item_id"), lists]

    held = items.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    listed = map_rows(held, "item_id long, terms array<binary>", lambda: run)
    return listed.select("item_id", F.explode("terms").alias("term")).distinct()


def _bucket_filter(terms: DataFrame) -> np.ndarray:
    """One bit per bucket that a term falls into. At most BUCKETS numbers reach the driver."""
    rows = terms.select(F.pmod(F.crc32("term"), F.lit(BUCKETS)).cast("int").alias("b")).distinct().toArrow()
    bits = np.zeros(BUCKETS, dtype=bool)
    bits[rows.column("b").to_numpy()] = True
    return np.packbits(bits)


class _Wanted(dict):
    """Whether a term falls into a bucket with a term of an item."""

    def __init__(self, packed: np.ndarray):
        super().__init__()
        self.bits = np.unpackbits(packed).astype(bool)

    def __missing__(self, term: bytes) -> bool:
        found = bool(self.bits[zlib.crc32(term) % BUCKETS])
        if len(self) >= MEMORY_TERMS:
            self.clear()
        self[term] = found
        return found


_LISTS = "term binary, shard long, slots array<int>, tfs array<int>, sizes array<int>, ids array<long>, docs long, terms long"


def _shard(number: int, held: list, schema: pa.Schema) -> pa.RecordBatch:
    """Lists of the documents (doc_id, size, terms) of a shard, slots by ascending doc_id; the first row, without a term, names them."""
    held.sort(key=lambda d: (d[0] is None, d[0] or 0))
    lists: dict[bytes, list[int]] = defaultdict(list)
    for slot, (_, _, terms) in enumerate(held):
        for term, tf in terms:
            entry = lists[term]
            entry.append(slot)
            entry.append(tf)
    sizes = np.array([d[1] for d in held], dtype=np.int32)
    entries = np.fromiter(chain.from_iterable(lists.values()), dtype=np.int64).reshape(-1, 2).astype(np.int32)
    rows = len(lists) + 1
    ends = pa.array(np.cumsum([0, len(held), *(len(x) // 2 for x in lists.values())], dtype=np.int32))
    first = np.arange(len(held), dtype=np.int32)

    def column(head: np.ndarray, tail: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([head, tail])))

    alone = pa.array([0, len(held), *[len(held)] * (rows - 1)], pa.int32())
    return pa.RecordBatch.from_arrays([
        pa.array([None, *lists], pa.binary()), pa.array([number] * rows, pa.int64()), column(first, entries[:, 0]),
        column(first, entries[:, 1]), column(sizes, sizes[entries[:, 0]]),
        pa.ListArray.from_arrays(alone, pa.array([d[0] for d in held], pa.int64())),
        pa.array([int((sizes > 0).sum())] + [None] * (rows - 1), pa.int64()),
        pa.array([int(sizes.sum(dtype=np.int64))] + [None] * (rows - 1), pa.int64()),
    ], schema=schema)


def inverted(docs: DataFrame, packed: np.ndarray) -> DataFrame:
    """Inverted lists of the documents by shard, of terms that the filter lets through."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = StructType.fromDDL(_LISTS)
    arrow = to_arrow_schema(schema)
    shared = spark.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _Wanted(shared.value)
        number, held, listed = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch, "text")):
                found = counted(text)
                terms = [(t, n) for t, n in found.items() if wanted[t]]
                held.append((doc_id, found.total(), terms))
                listed += len(terms)
                if len(held) >= SHARD_DOCS or listed >= LISTED:
                    yield _shard(number, held, arrow)
                    number, held, listed = number + 1, [], 0
        if held:
            yield _shard(number, held, arrow)

    return docs.where("text IS NOT NULL").select("doc_id", "text").mapInArrow(run, schema)


def weighted_terms(terms: DataFrame, lists: DataFrame, n_docs: int) -> DataFrame:
    """term, block, owner, weight, and the items of the block that hold the term, each with what it can still gain."""
    blocks = max(1, math.ceil(terms.select("item_id").distinct().count() / ITEMS))
    held = lists.where("term IS NOT NULL").groupBy("term").agg(F.sum(F.size("slots")).alias("df"))
    df = F.col("df").cast("double")
    owner = F.lit(len(RARITY))
    for i, one_in in reversed(list(enumerate(RARITY))):
        owner = F.when(df * one_in <= n_docs, i).otherwise(owner)
    known = stored(terms.join(held, "term").select(
        "item_id", "term", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block"), owner.cast("int").alias("owner"),
        F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * df + 1))).cast("long").alias("weight"),
    ), "item-terms")
    later = [
        (F.coalesce(F.sum(F.when(F.col("owner") > i, F.col("weight"))), F.lit(0)) * MOST).alias(f"later{i}")
        for i in range(len(RARITY))
    ]
    gains = known.groupBy(F.col("item_id").alias("item")).agg(F.array(*later).alias("later"))
    joined = known.join(gains, F.col("item_id").eqNullSafe(F.col("item")))
    return joined.groupBy("term", "block", "owner", "weight").agg(
        F.collect_list(F.struct("item_id", "later")).alias("items")
    )


def contributions(weights: np.ndarray, tfs: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What each list entry adds to the score of its document, in whole numbers."""
    if 90 * int(sizes.max(initial=0)) * n_docs < 1 << 63:
        m = 10 + (90 * sizes * n_docs) // n_terms
    else:
        m = np.array([10 + 90 * int(s) * n_docs // n_terms for s in sizes])
    return weights * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m))


def _lists_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    array = column.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    offsets = array.offsets.to_numpy()
    return offsets - offsets[0], array.flatten().to_numpy(zero_copy_only=False)


_BUNDLE = "shard long, block int, item_id long, slots array<int>, scores array<long>"
_FOUND = "item_id long, shard long, slot int, doc_id long, score long"


def _visited(owner: int, n_docs: int, n_terms: int, best: int):
    """The stage of an owner: bundles of a shard and a block of items with the owner's lists there."""
    last = owner == len(RARITY)
    schema = to_arrow_schema(StructType.fromDDL(_FOUND if last else _BUNDLE))

    def visit(key, bundles: pa.Table, lists: pa.Table) -> pa.Table:
        named = lists.filter(pc.is_valid(lists["ids"]))
        lists = lists.filter(pc.is_null(lists["ids"]))
        if not bundles.num_rows and not lists.num_rows:
            return schema.empty_table()
        ends, slots = _lists_of(lists["slots"]) if lists.num_rows else (np.zeros(1, int), np.zeros(0, int))
        starts_b, slots_b = _lists_of(bundles["slots"]) if bundles.num_rows else (np.zeros(1, int), np.zeros(0, int))
        width = 1 + max(slots.max(initial=-1), slots_b.max(initial=-1))
        totals: dict = defaultdict(lambda: np.zeros(width, dtype=np.int64))
        later: dict = {}
        if bundles.num_rows:
            _, scores = _lists_of(bundles["scores"])
            for i, item in enumerate(bundles["item_id"].to_pylist()):
                part = slice(starts_b[i], starts_b[i + 1])
                totals[item][slots_b[part]] += scores[part]
        if lists.num_rows:
            tfs, sizes = (_lists_of(lists[c])[1].astype(np.int64) for c in ("tfs", "sizes"))
            weights = np.repeat(lists["weight"].to_numpy(), np.diff(ends))
            added = contributions(weights, tfs, sizes, n_docs, n_terms)
            for i, items in enumerate(lists["items"].to_pylist()):
                part = slice(ends[i], ends[i + 1])
                for item in items:
                    totals[item["item_id"]][slots[part]] += added[part]
                    later[item["item_id"]] = item["later"]
        if last:
            return _selected(key, totals, named["ids"][0].values, best, schema)
        rows = []
        for item, total in totals.items():
            kept = np.flatnonzero(total)
            if item in later and len(kept) > best:
                scores = total[kept]
                reached = np.partition(scores, -best)[-best]
                kept = kept[scores + later[item][owner] >= reached]
            rows.append((item, kept, total[kept]))
        ends = pa.array(np.cumsum([0, *(len(r[1]) for r in rows)], dtype=np.int32))
        lists_ = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([r[i] for r in rows]), kind)) for i, kind in ((1, pa.int32()), (2, pa.int64()))]
        shard, block = (k.as_py() for k in key)
        return pa.Table.from_arrays(
            [pa.array([shard] * len(rows), pa.int64()), pa.array([block] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()), *lists_],
            schema=schema,
        )

    return visit


def _selected(key, totals: dict, ids: pa.Array, best: int, schema: pa.Schema) -> pa.Table:
    """The best documents of each item in a shard; slots ascend with doc_id, so the lower slot wins a tie."""
    rows = []
    for item, total in totals.items():
        found = np.flatnonzero(total > 0)
        first = found[np.lexsort((found, -total[found]))[:best]]
        rows += [(item, key[0].as_py(), int(slot), ids[int(slot)].as_py(), int(total[slot])) for slot in first]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema) if rows else schema.empty_table()


def ranked_search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id and score of the `best` documents of each item, fewer if fewer score above 0."""
    spark = docs.sparkSession
    terms = stored(item_terms(items), "query-terms")
    lists = stored(inverted(docs, _bucket_filter(terms)), "inverted-lists")
    n_docs, n_terms = lists.agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0
    weights = weighted_terms(terms, lists, n_docs)
    path = scratch_path(spark, "owned-lists")
    owned = lists.where("term IS NOT NULL").drop("ids", "docs", "terms").join(weights, "term")
    owned.select(
        "owner", "shard", "block", "slots", "tfs", "sizes", "weight", "items", F.lit(None).cast("array<long>").alias("ids")
    ).write.partitionBy("owner").parquet(path)
    kept = "shard long, block int, slots array<int>, tfs array<int>, sizes array<int>, weight long, items array<struct<item_id: long, later: array<long>>>, ids array<long>, owner int"
    owned = spark.read.schema(kept).parquet(path)

    # each shard names its documents to the last owner, once for each block of items that has bundles there
    names = lists.where("term IS NULL").select("shard", "ids")
    present = owned.select("shard", "block").distinct()
    names = present.join(names, "shard").select(
        "shard", "block", *(F.lit(None).cast(owned.schema[c].dataType).alias(c) for c in ("slots", "tfs", "sizes", "weight", "items")), "ids"
    )
    bundles = spark.createDataFrame([], _BUNDLE)
    for owner in range(len(RARITY) + 1):
        here = owned.where(F.col("owner") == owner).drop("owner")
        if owner == len(RARITY):
            here = here.unionByName(names)
        visit = _visited(owner, n_docs, max(1, n_terms), best)
        schema = _FOUND if owner == len(RARITY) else _BUNDLE
        bundles = bundles.groupBy("shard", "block").cogroup(here.groupBy("shard", "block")).applyInArrow(visit, schema)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "shard", "slot")
    placed = bundles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return placed.select("item_id", "rank", "doc_id", "score")


def op12_pipelined_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP12_SQL = rf"""WITH words AS (
    SELECT r, doc_id, unnest({_SQL_TERMS}) AS term
    FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
counts AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY r, doc_id, term),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY r),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
held AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
wanted AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark),
weighted AS (SELECT item_id, term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM wanted JOIN held USING (term), whole),
scored AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
    FROM weighted JOIN counts USING (term) JOIN sizes USING (r), whole GROUP BY item_id, r, doc_id),
placed AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS place
    FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 10"""
