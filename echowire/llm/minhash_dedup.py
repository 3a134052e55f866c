"""Near-duplicate documents by HyperMinHash: registers of leading-zero counts and mantissa bits.

A document is the set of its distinct shingles of five words. Equal sets form a class, and one document of each
class goes on. Its set is reduced to registers: the hash range is cut into buckets and each keeps, of the smallest
second hash, the number of leading zeros and the ten bits behind the first one. Bands of registers are hashed; classes
that share a band are candidates. Candidates pass an estimate of the Jaccard similarity, corrected for register
collisions and taken with a margin of five deviations, and are then verified on their full sets.

Groups are not expanded into all pairs. Every class is first compared with the pivot of each of its bands, the class
that shares its bands with most others (of these the smallest id). A group of copies of one text is joined by that text
in linear work. Only classes of one band that are still in different components
are then compared with each other, in blocks of bounded size: by registers, then by their whole sets in 32-bit hashes.
A block returns no more than a spanning forest of its links and the pairs too near the threshold to tell, and these are
verified on full sets. So no link that would join two components is lost.

With BANDS x BAND_ROWS registers, two documents at the threshold share a band with probability 1 - 2e-5, and more
similar ones nearly always.

Cases: a null or empty text and a text of white space have no shingles and link with nothing; a text of fewer than five
words is one shingle. Rows that repeat a doc_id are one document, and each is returned. A null id links with nothing,
has no component and is not kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echowire.llm.components import connected
from echowire.llm.frames import map_rows, table, texts, utf8
from echowire.llm.pairing import against_pivots, block_pairs, groups
from echowire.llm.shingles import mixed, shingle_set
from echowire.session import stored

WORDS = 5
#: Similarity in hundredths from which documents link.
PERCENT = 75
BANDS = 40
BAND_ROWS = 5
#: Mantissa bits of a register; six more hold the leading-zero count.
MANTISSA = 10
EMPTY = 0xFFFF
#: Deviations by which an estimate may fall short of the threshold.
MARGIN = 5.0
#: Rows of a block of candidates.
BLOCK = 1024
#: Ids (8 bytes each) that may be broadcast.
BROADCAST_IDS = 1_000_000


def registers(shingles: np.ndarray, n: int = BANDS * BAND_ROWS) -> np.ndarray:
    """HyperMinHash registers (16 bits) of a sorted set of 64-bit hashes."""
    out = np.full(n, EMPTY, dtype=np.uint16)
    if not len(shingles):
        return out
    bucket = ((shingles >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)  # ascending, like the hashes
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    least = np.minimum.reduceat(mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
    fraction, exponent = np.frexp((least >> np.uint64(11)).astype(np.float64))
    zeros = 53 - exponent
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64).clip(0)
    out[bucket[starts].astype(np.int64)] = (zeros << MANTISSA) | mantissa
    return out


def zero_chances(load: np.ndarray) -> np.ndarray:
    """Chance of each leading-zero count of a register, by the mean number of shingles in its bucket (rows x counts)."""
    at = 2.0 ** -np.arange(0, 54)
    load = np.maximum(np.asarray(load, dtype=float), 1e-9)[..., None]
    p = np.exp(-load * at[1:]) - np.exp(-load * at[:-1])
    return p / np.maximum(p.sum(-1, keepdims=True), 1e-12)


class Sketches:
    """Registers of some sets and what estimates need of each."""

    def __init__(self, rows: list[bytes], n: np.ndarray):
        self.rows = np.stack([np.frombuffer(r, np.uint16) for r in rows])
        self.n = np.asarray(n, dtype=float)
        held = self.rows != EMPTY
        self.other = np.where(held, self.rows, EMPTY - 1)  # two empty registers do not agree
        self.held = held.astype(np.float32)
        self.zeros = zero_chances(self.n / self.rows.shape[1])

    def plausible(self, i: int, others: np.ndarray, percent: int) -> np.ndarray:
        """Those of `others` that may have the similarity with row i.

        The share of equal registers is corrected for registers that agree by chance. Sizes alone rule out many pairs.
        Registers sample the union without replacement, so the deviation shrinks as they come to hold most of it.
        """
        limit = percent / 100
        others = others[100 * np.minimum(self.n[i], self.n[others]) >= percent * np.maximum(self.n[i], self.n[others])]
        if not len(others):
            return others
        equal = np.count_nonzero(self.rows[i] == self.other[others], axis=1)
        used = self.held[i].sum() + self.held[others].sum(1) - self.held[others] @ self.held[i]
        chance = self.zeros[others] @ self.zeros[i] / (1 << MANTISSA)
        estimate = (equal / used - chance) / (1 - chance)
        union = np.maximum((self.n[i] + self.n[others]) / (1 + limit), used)
        deviation = np.sqrt(limit * (1 - limit) / used * np.maximum(1 - used / union, 0.05))
        return others[estimate >= limit - MARGIN * deviation - 1 / used]

    def first_band(self, i: int, others: np.ndarray) -> np.ndarray:
        """The first band in which row i and each of the others agree."""
        same = (self.rows[i] == self.rows[others]).reshape(len(others), BANDS, BAND_ROWS).all(-1)
        held = ((self.held[i] + self.held[others]) > 0).reshape(len(others), BANDS, BAND_ROWS).any(-1)
        return (same & held).argmax(1)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have a Jaccard similarity of at least percent / 100."""
    if not len(a) or not len(b):
        return False
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, set_hash (null without shingles) and registers of each document."""

    def make():
        def run(batch: pa.RecordBatch) -> list:
            n, sets, found = [], [], []
            for text in utf8(batch, "text"):
                shingles = shingle_set(text, words)
                n.append(len(shingles))
                sets.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                found.append(registers(shingles).tobytes() if len(shingles) else None)
            return [batch.column("doc_id"), n, sets, found]

        return run

    return map_rows(texts(docs), "doc_id long, n_shingles long, set_hash binary, registers binary", make)


def band_rows(classes: DataFrame) -> DataFrame:
    """key, band and id for each band of each class; a band without any shingle is left out."""

    def make():
        def run(batch: pa.RecordBatch) -> list:
            ids = batch.column("id").to_numpy()
            rows = np.stack([np.frombuffer(x, np.uint16) for x in batch.column("registers").to_pylist()])
            rows = rows.reshape(len(ids), BANDS, BAND_ROWS)
            band = np.broadcast_to(np.arange(BANDS, dtype=np.int32), (len(ids), BANDS))
            key = band.astype(np.uint64)
            for i in range(BAND_ROWS):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, i].astype(np.uint64) + np.uint64(1))
            held = (rows != EMPTY).any(-1)
            return [key[held].view(np.int64), band[held], np.repeat(ids, BANDS).reshape(-1, BANDS)[held]]

        return run

    return map_rows(classes.select("id", "registers"), "key long, band int, id long", make)


def _text_sets(words: int):
    def prepare(text: str) -> np.ndarray:
        return shingle_set((text or "").encode(), words)

    return prepare


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id and value (the text) of the documents in `ids`, a table of distinct ids.

    Up to BROADCAST_IDS ids are broadcast and no text is shuffled; a longer list is joined by shuffle.
    """
    ids = stored(ids, "wanted")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    found = texts(docs).join(ids, F.col("doc_id") == F.col("id"), "left_semi")
    return found.select(F.col("doc_id").alias("id"), F.col("text").alias("value"))


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of documents whose full sets are similar enough. Only texts of documents in a pair travel on."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    held = stored(_texts_of(docs, ids), "candidate-texts")
    return against_pivots(pairs, held, _text_sets(words), lambda a, b: linked(a, b, percent))


def _estimated_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that pass the estimate."""
    values = classes.select("id", F.struct("registers", "n_shingles").alias("value"))

    def test(a: dict, b: dict) -> bool:
        both = Sketches([a["registers"], b["registers"]], np.array([a["n_shingles"], b["n_shingles"]]))
        return len(both.plausible(0, np.array([1]), percent)) > 0

    return against_pivots(pairs, values, lambda value: value, test)


def _short_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """id and short_set (sorted 32-bit hashes as bytes) of the documents in `ids`."""

    def make():
        def run(batch: pa.RecordBatch) -> list:
            sets = [(shingle_set(t, words) >> np.uint64(32)).astype(np.uint32).tobytes() for t in utf8(batch, "value")]
            return [batch.column("id"), sets]

        return run

    return map_rows(_texts_of(docs, ids), "id long, short_set binary", make)


def _join_block(group: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    """Pairs of one pair of blocks that join components, and pairs too close to the threshold for short hashes.

    A pair is looked at in its first common band only. Among pairs that are similar by a clear margin a spanning
    forest is enough.
    """
    ids, component, block, band = (group[c].to_numpy() for c in ("id", "component", "block", "band"))
    sketches = Sketches(group["registers"].to_pylist(), group["n_shingles"].to_numpy())
    sets = [np.frombuffer(x, np.uint32) for x in group["short_set"].to_pylist()]
    split = group["left"][0].as_py() != group["right"][0].as_py()
    up = {c: c for c in component.tolist()}

    def root(c: int) -> int:
        while up[c] != c:
            up[c] = up[up[c]]
            c = up[c]
        return c

    firsts, seconds = [], []
    places = np.arange(len(ids))
    for i in range(len(ids)):
        others = places[(block > block[i]) if split else (places > i)]
        others = sketches.plausible(i, others[component[others] != component[i]], percent)
        if len(others):
            others = others[sketches.first_band(i, others) == band[i]]
        if not len(others):
            continue
        sizes = np.array([len(sets[j]) for j in others])
        every = np.concatenate([sets[j] for j in others])
        at = np.minimum(np.searchsorted(sets[i], every), len(sets[i]) - 1)
        common = np.add.reduceat((sets[i][at] == every).astype(np.int64), np.r_[0, np.cumsum(sizes)[:-1]])
        total = sizes + len(sets[i])

        def similar(n: np.ndarray) -> np.ndarray:
            return 100 * n >= percent * (total - n)

        # Short hashes agree by chance in sets of hundreds of thousands: that many and eight deviations, two at least.
        chance = sizes * (len(sets[i]) / 2**32)
        clear = similar(common - 2 - np.ceil(chance + 8 * np.sqrt(chance) - 0.5).clip(0).astype(np.int64))
        for j, sure in zip(others[similar(common + 2)], clear[similar(common + 2)]):
            a, b = root(int(component[i])), root(int(component[j]))
            if sure and a == b:
                continue
            if sure:
                up[max(a, b)] = min(a, b)
            firsts.append(int(min(ids[i], ids[j])))
            seconds.append(int(max(ids[i], ids[j])))
    return firsts, seconds


def _plausible_ids(group: pa.Table, percent: int) -> np.ndarray:
    """Ids of one pair of blocks that may be similar to one of another component, by registers."""
    ids, component, block = (group[c].to_numpy() for c in ("id", "component", "block"))
    sketches = Sketches(group["registers"].to_pylist(), group["n_shingles"].to_numpy())
    split = group["left"][0].as_py() != group["right"][0].as_py()
    places, found = np.arange(len(ids)), np.zeros(len(ids), dtype=bool)
    for i in range(len(ids)):
        others = places[(block > block[i]) if split else (places > i)]
        others = sketches.plausible(i, others[component[others] != component[i]], percent)
        found[others] = True
        found[i] |= len(others) > 0
    return ids[found]


_BLOCK_KEYS = ["key", "left", "right"]


def _in_blocks(rows: DataFrame, values: DataFrame) -> DataFrame:
    """Rows (key, band, id, component) of the bands that hold several components, in sorted pairs of blocks."""
    mixed_keys = rows.groupBy("key").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low <> high").select("key", "n")
    cut = block_pairs(rows.join(mixed_keys, "key"), "n", "id", BLOCK).join(values, "id")
    return cut.repartition(*_BLOCK_KEYS).sortWithinPartitions(*_BLOCK_KEYS, "block", "id")


def _across_components(shared: DataFrame, classes: DataFrame, joined: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a < b) of one band and different components that join all components that belong together.

    A first pass over registers alone finds the few documents that need their sets compared.
    """
    rows = shared.join(joined, "id", "left").select("key", "band", "id", F.coalesce("component", "id").alias("component"))
    rows = stored(rows, "bands")
    registers_of = classes.select("id", "registers", "n_shingles")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, _BLOCK_KEYS):
            yield pa.RecordBatch.from_arrays([pa.array(_plausible_ids(group, percent), pa.int64())], names=["id"])

    needed = stored(_in_blocks(rows, registers_of).mapInArrow(find, "id long").distinct(), "plausible")
    values = registers_of.join(_short_sets(docs, needed, words), "id")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def join_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, _BLOCK_KEYS):
            found = _join_block(group, percent)
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], schema=schema)

    blocks = _in_blocks(rows.join(needed, "id"), values)
    return blocks.mapInArrow(join_all, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept of each document."""
    rows = stored(signatures(docs, words), "signatures")
    held = rows.where("doc_id IS NOT NULL AND set_hash IS NOT NULL")
    classes = stored(
        held.groupBy("set_hash").agg(
            F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")
        ), "classes",
    )
    bands = band_rows(classes)
    heads = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(bands.join(heads, "key"), "shared-bands")
    # the text that others were copied from shares most bands with them
    weights = shared.groupBy("id").agg(F.sum("n").alias("weight"))
    rank = F.struct("weight", (-F.col("id")).alias("id"))
    pivots = shared.join(weights, "id").groupBy("key").agg((-F.max(rank)["id"]).alias("pivot"))
    pairs = shared.join(pivots, "key").where("id <> pivot")
    pairs = pairs.select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    pairs = stored(_estimated_pairs(pairs, classes, percent), "pivot-pairs")
    links = stored(verified(pairs, docs, words, percent), "pivot-links")
    edge = (F.col("a").alias("src"), F.col("b").alias("dst"))
    joined = stored(connected(links.select(*edge)), "joined")

    rest = stored(_across_components(shared.drop("n"), classes, joined, docs, words, percent), "rest-pairs")
    more = stored(verified(rest, docs, words, percent), "rest-links")
    starred = joined.where("id <> component").select(F.col("id").alias("src"), F.col("component").alias("dst"))
    component = connected(starred.unionByName(more.select(*edge)))

    of_class = classes.join(component, "id", "left").select("set_hash", F.coalesce("component", "id").alias("component"))
    return rows.join(of_class, "set_hash", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNotNull() & (F.col("doc_id") == F.coalesce("component", "doc_id"))).alias("kept"),
    )


def _told_apart(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`docs` with the column __id, and the ids that several rows have, a stored table.

    __id is the doc_id; where rows of one id have different texts, a hash of id and text; without an id, a hash of the text.
    Hashes are above 2**62, so that of a group a document with an id of its own stays.
    """
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    counted = stored(docs.groupBy("doc_id", text_hash.alias("__hash")).agg(F.count("*").alias("n")), "ids-and-texts")
    differing = counted.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts > 1")
    differing = stored(differing.select(F.col("doc_id").alias("__doc"), F.lit(True).alias("__again")), "repeated-ids")
    if differing.count() <= BROADCAST_IDS:
        differing = F.broadcast(differing)

    def named(rows: DataFrame, hashed: Column) -> DataFrame:
        marked = rows.join(differing, F.col("doc_id") == F.col("__doc"), "left")
        high = F.lit(1 << 62)
        own = F.when(F.col("doc_id").isNull() | F.col("__again"), F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), hashed), high) + high)
        own = own.otherwise(F.col("doc_id"))
        return marked.withColumn("__id", own).drop("__doc", "__again")

    copies = named(counted.where("n > 1"), F.col("__hash")).select("__id")
    return named(docs, text_hash), stored(copies, "repeated-rows")


def drop_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """One document of each group of near duplicates, with all its columns.

    Rows of one id with different texts are documents of their own, and so are rows without an id. Of rows with the same
    id and text, or without an id and with the same text, one stays.
    """
    told, copies = _told_apart(docs)
    found = near_duplicates(told.select(F.col("__id").alias("doc_id"), "text"), **settings)
    gone = stored(found.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct(), "near-copies")
    left = told.join(gone, told["__id"] == gone["__gone"], "left_anti")
    n = copies.count()
    if n:
        if n <= BROADCAST_IDS:
            copies = F.broadcast(copies)
        single = left.join(copies, "__id", "left_anti")
        left = single.unionByName(left.join(copies, "__id", "left_semi").dropDuplicates(["__id"]))
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))


def op3_hyperminhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
