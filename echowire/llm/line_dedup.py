"""Line dedup over range-partitioned hashes.

Each document is reduced to one row per distinct line key: a 128-bit hash, the document and the places of the key.
These rows are range-partitioned by (hash, document) and sorted by hash, document and position; a stream over the
sorted rows counts the documents of each key and meets its first occurrence first. A key that spans several
partitions, as a very common line does, is counted in each and the few partial counts are added. The result is a
compressed keep bitmap for each document that loses lines, no text.

Cases: a null or empty text is one empty line; empty keys never count. Rows that repeat a doc_id are one document when
documents are counted, and each gets its own result; null ids are one document. An empty table gives no rows. A line is
held whole in memory, a key's documents are never gathered.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echowire.llm.frames import map_rows, table, texts, utf8
from echowire.session import stored

#: Documents in which a key is found before its lines go.
MIN_DOCS = 10
#: Code points that a key has at least.
MIN_CHARS = 1

_BLANK = b" \t\n\x0b\x0c\r"
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_KEY = ["h1", "h2"]


def _keys(text: bytes, min_chars: int) -> tuple[int, dict[bytes, list[int]]]:
    """Number of lines, and the places of each key's 128-bit hash."""
    lines = text.translate(_LOWER).split(b"\n")
    places: dict[bytes, list[int]] = {}
    for at, line in enumerate(lines):
        line = line.strip(_BLANK)
        if line and (min_chars <= 1 or len(line.decode("utf-8", "replace")) >= min_chars):
            places.setdefault(xxhash.xxh3_128_digest(line), []).append(at)
    return len(lines), places


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document and distinct key: h1, h2, doc_id, text_hash, n_lines, places."""

    def make():
        def run(batch: pa.RecordBatch) -> list:
            rows = []
            ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            for doc, text_hash, text in zip(ids, hashes, utf8(batch, "text")):
                n, places = _keys(text, min_chars)
                for key, at in places.items():
                    high, low = np.frombuffer(key, ">i8")
                    rows.append((int(high), int(low), doc, text_hash, n, at))
            return list(zip(*rows)) if rows else [[]] * 6

        return run

    source = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    return map_rows(source, "h1 long, h2 long, doc_id long, text_hash long, n_lines int, places array<int>", make)


def _count_runs(min_docs: int):
    """Stream sorted (h1, h2, doc_id, at) rows; one row for each key that can be frequent.

    These are the keys with enough documents in this partition, and the first and last key, which may go on in
    the neighbours.
    """
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int64()), ("doc", pa.int64()), ("at", pa.int32())])

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found) if found else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key = None  # h1, h2, documents, first document, first place of the key that is being counted
        last_doc, told_first = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
            doc = batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
            at = batch.column("at").to_numpy()
            new_key = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            new_doc = new_key | np.r_[True, doc[1:] != doc[:-1]]
            goes_on = open_key is not None and (h1[0], h2[0]) == open_key[:2]
            if goes_on and doc[0] == last_doc:
                new_doc[0] = False
            starts = np.flatnonzero(new_key)
            counts = np.add.reduceat(new_doc.astype(np.int64), starts)
            found = []
            if goes_on:
                open_key = (*open_key[:2], open_key[2] + int(counts[0]), *open_key[3:])
                starts, counts = starts[1:], counts[1:]
            if len(starts):
                if open_key is not None:
                    if not told_first or open_key[2] >= min_docs:
                        found.append(open_key)
                    told_first = True
                told = counts[:-1] >= min_docs
                if len(told) and not told_first:
                    told[0] = told_first = True
                for i in np.flatnonzero(told):
                    s = starts[i]
                    found.append((int(h1[s]), int(h2[s]), int(counts[i]), int(doc[s]), int(at[s])))
                s = starts[-1]
                open_key = (int(h1[s]), int(h2[s]), int(counts[-1]), int(doc[s]), int(at[s]))
            last_doc = doc[-1]
            yield rows(found)
        if open_key is not None:
            yield rows([open_key])

    return run


def frequent_keys(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """h1, h2, n_docs and the first occurrence (first_doc, first_at) of the keys found in enough documents."""
    placed = rows.select(*_KEY, "doc_id", F.col("places")[0].alias("at"))
    placed = placed.repartitionByRange(*_KEY, "doc_id").sortWithinPartitions(*_KEY, "doc_id", "at")
    runs = placed.mapInArrow(_count_runs(min_docs), "h1 long, h2 long, n long, doc long, at int")
    found = runs.groupBy(*_KEY).agg(F.sum("n").alias("n_docs"), F.min(F.struct("doc", "at")).alias("__first"))
    return found.where(F.col("n_docs") >= min_docs).select(
        *_KEY, "n_docs", F.col("__first.doc").alias("first_doc"), F.col("__first.at").alias("first_at")
    )


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """doc_id, text_hash, n_dropped and keep (compressed bitmap) of each document that loses lines.

    Documents without a row keep every line. With `keep_first` the first occurrence of a key, in the document of the
    lowest id and there at the first place, stays.
    """
    rows = stored(line_rows(docs, min_chars), "lines")
    frequent = frequent_keys(rows, min_docs)
    dropped = rows.join(frequent, _KEY)
    places = F.col("places")
    if keep_first:
        owner = F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("first_doc")
        places = F.when(owner, F.slice("places", 2, F.greatest(F.lit(1), F.size("places")))).otherwise(places)
    per_doc = (
        dropped.select("doc_id", "text_hash", "n_lines", places.alias("places"))
        .where(F.size("places") > 0)
        .groupBy("doc_id", "text_hash", "n_lines")
        .agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    )

    def make():
        def run(batch: pa.RecordBatch) -> list:
            dropped_n, maps = [], []
            for n, at in zip(batch.column("n_lines").to_pylist(), batch.column("places").to_pylist()):
                keep = np.ones(n, dtype=bool)
                keep[at] = False
                dropped_n.append(len(at))
                maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
            return [batch.column("doc_id"), batch.column("text_hash"), dropped_n, maps]

        return run

    return map_rows(per_doc, "doc_id long, text_hash long, n_dropped long, keep binary", make)


def kept_text(text: str, keep: bytes | None) -> str:
    """The lines of the text whose bit is set, joined again."""
    if keep is None:
        return text
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return "\n".join(line for line, bit in zip(lines, bits) if bit)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """`docs` with the columns __dropped and __keep; both null where a document keeps every line."""
    marks = bitmaps.select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"),
        F.col("n_dropped").alias("__dropped"), F.col("keep").alias("__keep"),
    )
    same = docs["doc_id"].eqNullSafe(marks["__doc"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == marks["__hash"])
    return docs.join(marks, same, "left").drop("__doc", "__hash")


def drop_lines(docs: DataFrame, **settings) -> DataFrame:
    """The documents with their remaining lines as text; a document that lost all its lines goes."""

    @F.pandas_udf("string")
    def applied(text: pd.Series, keep: pd.Series) -> pd.Series:
        return pd.Series([kept_text(t or "", k) for t, k in zip(text, keep)], dtype=object)

    marked = with_bitmaps(docs, keep_bitmaps(docs, **settings))
    text = F.when(F.col("__keep").isNull(), F.col("text")).otherwise(applied("text", "__keep"))
    cleaned = marked.withColumn("__text", text)
    gone = F.col("__keep").isNotNull() & (F.trim(F.translate("__text", "\n\t\r", "   ")) == "")
    return cleaned.where(~gone).select(*(F.col("__text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))


def digests(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Per document: n_lines before dropping, n_dropped, and SHA-256 of the text that is kept."""

    def make():
        def run(batch: pa.RecordBatch) -> list:
            n, sha = [], []
            for text, keep in zip(batch.column("text").to_pylist(), batch.column("__keep").to_pylist()):
                n.append(text.count("\n") + 1)
                sha.append(hashlib.sha256(kept_text(text, keep).encode()).hexdigest())
            return [batch.column("doc_id"), n, batch.column("__dropped").fill_null(0), sha]

        return run

    marked = with_bitmaps(texts(docs), bitmaps)
    return map_rows(marked, "doc_id long, n_lines long, n_dropped long, kept_sha256 string", make)


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digests(docs, keep_bitmaps(docs))


OP5_SQL = r"""WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (SELECT key FROM frequent)) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (key NOT IN (SELECT key FROM frequent)), ''))
        AS kept_sha256
FROM keyed GROUP BY doc_id"""
