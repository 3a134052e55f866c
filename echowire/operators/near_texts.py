"""Articles with similar texts: an exact set-similarity join of word shingles.

The shingles of a text are the distinct runs of five words of its normalised form, held as 64-bit hashes; a shorter
text is one shingle, a text without words has none and is similar to nothing. Two texts are similar when their Jaccard
similarity reaches a percentage, 75 by default.

Articles with equal normalised texts are one class, compared once. All shingles are put into one global order, rarest
first. Two similar sets must share a shingle among the first few of both (the prefix), at places that leave room for
enough common ones; only pairs that do are compared on their whole sets. A shingle of a single class cannot be shared,
so such shingles fill places of the prefix but are never sent anywhere.

Size: all shingles move once, straight from the texts to the partition that counts them, as a hash with the hash of the
class and the size of its set; only the shared ones go on and are written. Prefix shingles lie by the lowest class that
has them, so most shingles of a cluster of near copies meet in one place and its pairs leave once for all of them. The
classes of a frequent prefix shingle are cut into blocks of BLOCK classes, every two of which meet in one place.
Sets travel to where their pairs are compared: classes with the same lowest partner share a hash block, so a set is sent
about once, however many candidates it is in. Candidates that pass the filters and results between different texts are
as many as the data has; copies never multiply them.

Cases: rows without an article id or an approval id are left out, as in the other features; of several approvals of an
article the one with the lowest id counts. Empty tables give no rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echowire.functions.texts import content_hash, normalize_text
from echowire.operators.features import content_features
from echowire.operators.skew import attach
from echowire.session import stored

# The task function travels with its helpers, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a shingle, and the least similarity in percent.
WIDTH, PERCENT = 5, 75
#: Classes of one shingle that meet another such block in one place, as a power of two.
BLOCK_BITS = 8
#: Bytes of sets in a hash block.
SET_BYTES = 16 << 20
#: Candidates that are compared in one group, and shingles that a task looks up at once.
GROUP_PAIRS, LOOKUPS = 1 << 16, 1 << 20
#: Rows of prefixes that a task pairs at once, and pairs it holds before repeated ones are dropped.
PREFIX_ROWS, HELD_PAIRS = 1 << 16, 1 << 21


def shingles(headline: Column | str, text: Column | str, width: int = WIDTH) -> Column:
    """Distinct shingle hashes of the normalised headline and text together, sorted."""
    whole = F.trim(F.concat(normalize_text(headline), F.lit(" "), normalize_text(text)))

    def hashed(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - width + 1, F.lit(1)))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, width)))
        return F.when(F.element_at(words, 1) != "", F.array_sort(F.array_distinct(hashes))).otherwise(F.array().cast("array<bigint>"))

    # The text is split once per row: an expression inside the lambda would be evaluated for each shingle.
    return F.element_at(F.transform(F.array(F.split(whole, " ")), hashed), 1)


def _classes(keys: DataFrame) -> DataFrame:
    """key, classId, articles of each class of `content_features`."""
    return keys.groupBy("key").agg(F.min("articleId").alias("classId"), F.count("*").alias("articles"))


def _members(keys: DataFrame, classes: DataFrame) -> DataFrame:
    return attach(keys, classes, ["key"], ["articleId"], size="articles").select("articleId", "classId", "articles")


def text_classes(approved: DataFrame) -> DataFrame:
    """articleId, classId: articles with equal normalised headline and text, named by their lowest id."""
    keys = content_features(approved)
    return _members(keys, _classes(keys))


def class_sets(approved: DataFrame, width: int = WIDTH) -> DataFrame:
    """classId, articles, size and shingles of each class, also of those without shingles.

    Shingles are hashed where texts are read, and copies are reduced before the shuffle.
    """
    classes = _classes(content_features(approved))
    held = approved.where("articleId IS NOT NULL AND id IS NOT NULL").select(
        content_hash("headline", "text").alias("key"), shingles("headline", "text", width).alias("shingles")
    )
    one = held.groupBy("key").agg(F.first("shingles").alias("shingles"))
    return classes.join(one, "key").select("classId", "articles", F.size("shingles").cast("long").alias("size"), "shingles")


def shared_shingles(approved: DataFrame, classes: DataFrame, width: int = WIDTH) -> DataFrame:
    """classId, size, and the shingles that several classes have, rarest first, of each class of `classes` with any.

    Shingles are counted with those of copies and of superseded approvals, which only bears on their order. The count is
    a window over the partition that a shingle goes to: it holds at most one small row per approval.
    """
    held = approved.where("articleId IS NOT NULL AND id IS NOT NULL").select(
        F.xxhash64(content_hash("headline", "text")).alias("class"), shingles("headline", "text", width).alias("shingles")
    )
    each = held.select("class", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    of_one = Window.partitionBy("shingle")
    counted = each.select(
        "*", F.count("*").over(of_one).alias("n"), F.min("class").over(of_one).alias("low"), F.max("class").over(of_one).alias("high")
    )
    several = counted.where("low <> high").select("class", "size", "shingle", "n").dropDuplicates(["shingle", "class"])
    # The lists are made after the shuffle: before it a class has few shingles in one place.
    lists = several.repartition("class").groupBy("class", "size").agg(
        F.array_sort(F.collect_list(F.struct(F.col("n").alias("classes"), "shingle"))).alias("shared")
    )
    named = classes.select(F.xxhash64("key").alias("class"), "classId")
    return lists.join(named, "class").select("classId", F.col("size").cast("long").alias("size"), "shared")


def _prefixes(ordered: DataFrame, percent: int) -> DataFrame:
    """classId, size, place, shingle of the shared shingles in the prefix of each class."""
    alone = F.col("size") - F.size("shared")
    length = F.floor((100 - percent) * F.col("size") / 100) + 1
    prefix = ordered.select(
        "classId", "size", alone.alias("alone"),
        F.posexplode(F.slice("shared", F.lit(1), F.greatest(length - alone, F.lit(0)).cast("int"))).alias("place", "entry"),
    )
    return prefix.select("classId", "size", (F.col("alone") + F.col("place")).alias("place"), F.col("entry.shingle").alias("shingle"))


def _pairs_of(rows: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of classes in rows of whole groups, equal (left, right, shingle) one after another."""
    group = np.stack([rows.column(c).to_numpy() for c in ("left", "right", "shingle")])
    ids, size, place, block = (rows.column(c).to_numpy() for c in ("classId", "size", "place", "block"))
    split = group[0] != group[1]
    n = len(ids)
    starts = np.flatnonzero(np.r_[True, (group[:, 1:] != group[:, :-1]).any(0)])
    ends = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))
    names, at = np.unique(ids, return_inverse=True)
    held: list[np.ndarray] = []
    many = 0
    first, step = np.arange(n), 1
    while True:
        first = first[first + step < ends[first]]
        if not len(first):
            break
        second = first + step
        a, b = size[first], size[second]
        room = np.minimum(a - place[first], b - place[second])
        fits = (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & ((100 + percent) * room >= percent * (a + b))
        fits &= ~split[first] | (block[first] != block[second])
        x, y = at[first[fits]], at[second[fits]]
        held.append(np.minimum(x, y) * len(names) + np.maximum(x, y))
        many += len(x)
        if many > HELD_PAIRS:
            held = [np.unique(np.concatenate(held))]
            many = len(held[0])
            if many > HELD_PAIRS // 2:
                yield _named_pairs(held[0], names)
                held, many = [], 0
        step += 1
    if many:
        yield _named_pairs(np.unique(np.concatenate(held)), names)


def _named_pairs(codes: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
    both = [pa.array(names[codes // len(names)]), pa.array(names[codes % len(names)])]
    return pa.RecordBatch.from_arrays(both, names=["classId", "otherId"])


def _pairing(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < PREFIX_ROWS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            # The last group may go on in the next batch.
            last = np.ones(rows.num_rows, dtype=bool)
            for c in ("left", "right", "shingle"):
                values = rows.column(c).to_numpy()
                last &= values == values[-1]
            whole = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            yield from _pairs_of(rows.slice(0, whole), percent) if whole else ()
            held = rows.slice(whole).to_batches()
        if held:
            yield from _pairs_of(pa.Table.from_batches(held), percent)

    return run


def _candidates(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes, the lower id first, that share a prefix shingle at places that leave room for a match."""
    heads = prefixes.groupBy("shingle").agg(F.count("*").alias("n"), F.min("classId").alias("lowest")).where("n > 1")
    met = attach(prefixes, heads, ["shingle"], ["classId"], size="n")
    # Powers of two, so that the blocks of two shingles of a cluster hold the same classes.
    blocks = F.pow(F.lit(2), F.greatest(F.ceil(F.log2("n")) - BLOCK_BITS, F.lit(0))).cast("int")
    cut = met.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("classId"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumns({"left": F.least("block", "other"), "right": F.greatest("block", "other")}).drop("other", "blocks", "n")
    laid = cut.repartition("lowest", "left", "right").sortWithinPartitions("lowest", "left", "right", "shingle")
    return laid.mapInArrow(_pairing(percent), "classId bigint, otherId bigint").distinct()


def _common(percent: int):
    def common(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        ids, sizes = (sets.column(c).to_numpy() for c in ("classId", "size"))
        lists = sets.column("shared").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        ends = lists.offsets.to_numpy().astype(np.int64)
        names, codes = np.unique(lists.values.to_numpy(), return_inverse=True)
        pairs = pairs.sort_by("classId")
        order = np.argsort(ids)
        left, right = (order[np.searchsorted(ids[order], pairs.column(c).to_numpy())] for c in ("classId", "otherId"))
        shared, mark = np.zeros(len(left), np.int64), np.zeros(len(names), bool)
        lengths = ends[right + 1] - ends[right]
        starts = np.flatnonzero(np.r_[True, left[1:] != left[:-1]])
        for start, end in zip(starts, np.r_[starts[1:], len(left)]):
            own = codes[ends[left[start]] : ends[left[start] + 1]]
            mark[own] = True
            step = max(1, LOOKUPS // max(1, int(lengths[start:end].max())))
            for at in range(start, end, step):
                n = lengths[at : min(at + step, end)]
                before = np.cumsum(n) - n
                places = np.arange(n.sum()) + np.repeat(ends[right[at : at + len(n)]] - before, n)
                sums = np.r_[0, np.cumsum(mark[codes[places]])]
                shared[at : at + len(n)] = sums[before + n] - sums[before]
            mark[own] = False
        similar = (100 + percent) * shared >= percent * (sizes[left] + sizes[right])
        found = pairs.select(["classId", "otherId"]).append_column("common", pa.array(shared))
        found = found.append_column("size", pa.array(sizes[left])).append_column("otherSize", pa.array(sizes[right]))
        return found.filter(pa.array(similar))

    return common


def _in_blocks(candidates: DataFrame, ordered: DataFrame) -> DataFrame:
    """The candidates with the hash blocks `left` and `right` of their classes, and a part of the pairs of these blocks.

    Classes with the same lowest partner share a block, unless their sets are too large for one.
    """
    sides = candidates.unionByName(candidates.select(F.col("otherId").alias("classId"), F.col("classId").alias("otherId")))
    lowest = sides.groupBy("classId").agg(F.min("otherId").alias("low")).select("classId", F.least("classId", "low").alias("low"))
    sizes = ordered.select("classId", (8 * F.size("shared")).alias("bytes"))
    homes = stored(lowest.join(sizes, "classId"), "near-homes")
    blocks = max(1, math.ceil((homes.agg(F.sum("bytes")).first()[0] or 0) / SET_BYTES))
    large = homes.groupBy("low").agg(F.ceil(F.sum("bytes") / SET_BYTES).alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("classId"), F.coalesce("parts", F.lit(1)))
    # As few as there are blocks.
    placed = homes.join(F.broadcast(large), "low", "left")
    placed = stored(placed.select("classId", F.pmod(F.xxhash64("low", part), F.lit(blocks)).cast("int").alias("block")), "near-blocks")
    for name, side in (("classId", "left"), ("otherId", "right")):
        candidates = candidates.join(placed.select(F.col("classId").alias(name), F.col("block").alias(side)), name)
    keyed = stored(candidates, "placed-candidates")
    full = keyed.groupBy("left", "right").agg(F.ceil(F.count("*") / GROUP_PAIRS).alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("classId"), F.coalesce("parts", F.lit(1))).cast("int")
    return keyed.join(F.broadcast(full), ["left", "right"], "left").select("classId", "otherId", "left", "right", part.alias("part"))


def near_class_pairs(ordered: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of classes of `shared_shingles`, a stored table, at or above the similarity: classId, otherId (the higher id),
    common, size, otherSize. Articles of one class are not listed here."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    candidates = stored(_candidates(stored(_prefixes(ordered, percent), "prefixes"), percent), "near-candidates")
    keyed = _in_blocks(candidates, ordered)
    needed = keyed.select("classId", "left", "right", "part").unionByName(
        keyed.select(F.col("otherId").alias("classId"), "left", "right", "part")).distinct()
    sent = ordered.select("classId", "size", F.transform("shared", lambda s: s["shingle"]).alias("shared")).join(needed, "classId")
    sent = sent.withColumnsRenamed({"left": "toLeft", "right": "toRight", "part": "toPart"})
    sides = keyed.groupBy("left", "right", "part").cogroup(sent.groupBy("toLeft", "toRight", "toPart"))
    return sides.applyInArrow(
        _common(percent), "classId bigint, otherId bigint, common bigint, size bigint, otherSize bigint")


def near_text_pairs(approved: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Pairs of classes with similar texts, their similarity, and how many pairs of articles each stands for."""
    return _similar_classes(approved, stored(_classes(content_features(approved)), "text-classes"), percent, width)


def _similar_classes(approved: DataFrame, classes: DataFrame, percent: int, width: int) -> DataFrame:
    found = near_class_pairs(stored(shared_shingles(approved, classes, width), "shared-shingles"), percent)
    many = classes.select(F.col("classId").alias("id"), "articles")
    for name, alias in (("classId", "articles"), ("otherId", "otherArticles")):
        found = found.join(many.select(F.col("id").alias(name), F.col("articles").alias(alias)), name)
    both = F.col("size") + F.col("otherSize") - F.col("common")
    return found.select(
        "classId", "otherId", "common", "size", "otherSize", (F.col("common") / both).alias("similarity"),
        (F.col("articles").cast("decimal(19,0)") * F.col("otherArticles").cast("decimal(19,0)")).cast("decimal(38,0)").alias("pairs"),
    )


def near_text_report(approved: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """One row per article: classId, copies (other articles of its class), nearMatches (articles of similar classes) and
    its best similar class (the highest similarity, then the lowest id)."""
    keys = stored(content_features(approved), "text-keys")
    classes = stored(_classes(keys), "text-classes")
    pairs = stored(_similar_classes(approved, classes, percent, width), "near-pairs")
    many = classes.select(F.col("classId").alias("otherId"), "articles")
    sides = pairs.select("classId", "otherId", "similarity").unionByName(
        pairs.select(F.col("otherId").alias("classId"), F.col("classId").alias("otherId"), "similarity"))
    links = sides.join(many, "otherId").groupBy("classId").agg(
        F.sum("articles").alias("nearMatches"),
        F.max(F.struct("similarity", (-F.col("otherId")).alias("minusId"))).alias("best"),
    )
    members = _members(keys, classes)
    report = attach(members, links, ["classId"], ["articleId"], how="left")
    return report.select(
        "articleId", "classId", (F.col("articles") - 1).alias("copies"), F.coalesce("nearMatches", F.lit(0)).alias("nearMatches"),
        (-F.col("best.minusId")).alias("bestId"), F.col("best.similarity").alias("bestSimilarity"),
    )
