"""Token ids in files of length-delimited binary records, with a separate offset index.

A record is the length of its payload (8 bytes), the masked CRC-32C of these bytes (4), the payload, and the masked
CRC-32C of the payload (4), all little-endian. A payload is the doc_id (8 bytes), flags (4) and the ids, of two bytes each
where all fit (flag 2; flag 4: the last two bytes fill up a word), else of four; flag 1 stands for a null doc_id. The
index beside each file has 24 bytes for each record: its offset, the length of its payload and the ids before it in
the file. So a reader can go to any record without reading those before.

Files are written by Spark tasks through a data source and named by task and attempt; a file counts only when the
driver has listed it in the manifest after all tasks have ended, so lost executors and repeated attempts leave no
trace in what is read. The manifest has one entry per file. A reader checks all lengths and checksums.

Order: documents are range-partitioned by doc_id (null first), equal ids by a hash of their text and their place, so
that many rows of one id are spread too. Texts are encoded where they are written.

Cases: a null or empty text gives the end id alone. Repeated rows are records of their own. An empty table gives a
manifest without files. Texts of any length are one record; a task holds one slice of them at a time.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from echowire.llm import checksums
from echowire.llm.frames import map_rows, small_batches, strings, table, texts
from echowire.session import scratch_path

# The data source travels with its helpers, so executors need not have this package to read and write files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(checksums)

FORMAT = "length_delimited_records"
MANIFEST = "_manifest.json"
#: Id appended to each document.
END_ID = 1

_HEAD = 6  # words before the ids of a record: length, its checksum, doc_id, flags
NO_ID, NARROW, PADDED = 1, 2, 4  # flags
_INDEX = 3  # numbers of an index entry
#: Bytes of records that a reader holds at once, if a single record is not longer.
READ_BYTES = 8 << 20


def _located(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]+:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


# ------------------------------------------------------------------------- records


def framed(doc_ids: pa.Array, ids: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the records, where each of them starts (one more entry for the end), and how many ids each has."""
    offsets = ids.offsets.to_numpy().astype(np.int64)
    values = ids.values.to_numpy(zero_copy_only=False).astype(np.uint32)[offsets[0] : offsets[-1]]
    counts = np.diff(offsets)
    narrow = int(values.max(initial=0)) < 1 << 16
    filled = (counts + 1) // 2 if narrow else counts
    starts = np.concatenate([[0], np.cumsum(filled + _HEAD + 1)])
    words, at = np.zeros(starts[-1], dtype=np.uint32), starts[:-1]
    lengths = (4 * (filled + 3)).astype(np.uint64)
    names = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    low = np.uint64(0xFFFFFFFF)
    words[at], words[at + 1] = lengths & low, lengths >> np.uint64(32)
    words[at + 3], words[at + 4] = names & low, names >> np.uint64(32)
    no_id = doc_ids.is_null().to_numpy(zero_copy_only=False)
    words[at + 5] = NO_ID * no_id + narrow * (NARROW + PADDED * (counts % 2))
    cells = words.view(np.uint16) if narrow else words
    cells[_places(at, counts, narrow)] = values
    words[at + 2] = checksums.masked(checksums.crc32c(words, at, at + 2))
    words[starts[1:] - 1] = checksums.masked(checksums.crc32c(words, at + 3, starts[1:] - 1))
    return words, starts, counts


def _places(starts: np.ndarray, counts: np.ndarray, narrow: np.ndarray | bool) -> np.ndarray:
    """Where the ids of records stand, counted in half words for narrow ones."""
    first = (starts + _HEAD) * np.where(narrow, 2, 1)
    return np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def unframed(words: np.ndarray, starts: np.ndarray, filled: np.ndarray) -> tuple[pa.Array, pa.ListArray]:
    """doc_ids and ids of the records that start at `starts` and have `filled` words of ids; raises if they are damaged."""
    ends = starts + _HEAD + filled
    long = words.astype(np.uint64)
    if (long[starts] + (long[starts + 1] << np.uint64(32)) != 4 * (filled + 3)).any():
        raise ValueError("the length of a record differs from its index entry")
    for first, last in ((starts, starts + 2), (starts + 3, ends)):
        if (checksums.masked(checksums.crc32c(words, first, last)) != words[last]).any():
            raise ValueError("the checksum of a record does not match")
    names = (long[starts + 3] + (long[starts + 4] << np.uint64(32))).view(np.int64)
    flags = words[starts + 5]
    narrow = (flags & NARROW) > 0
    counts = np.where(narrow, 2 * filled - ((flags & PADDED) > 0), filled)
    places = _places(starts, counts, narrow)
    if narrow.all():
        values = words.view(np.uint16)[places].astype(np.int32)
    else:
        each = np.repeat(narrow, counts)
        values = np.where(each, words.view(np.uint16)[places], words[np.where(each, 0, places)]).astype(np.uint32).view(np.int32)
    doc_ids = pa.array(names, pa.int64(), mask=(flags & NO_ID).astype(bool))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return doc_ids, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


# ------------------------------------------------------------------------- files


class _Written(WriterCommitMessage):
    def __init__(self, part: int, name: str, records: int, ids: int):
        self.part, self.name, self.records, self.ids = part, name, records, ids


class RecordWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        part = TaskContext.get().partitionId()
        name, (system, folder) = f"part-{part:06d}-{uuid.uuid4().hex}", _located(self.path)
        system.create_dir(folder)
        offset = ids = records = 0
        with system.open_output_stream(f"{folder}/{name}.rec") as data, system.open_output_stream(f"{folder}/{name}.idx") as index:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                words, starts, counts = framed(batch.column("doc_id"), batch.column("ids"))
                data.write(words.astype("<u4", copy=False))
                entries = np.empty((len(counts), _INDEX), dtype="<u8")
                entries[:, 0] = offset + 4 * starts[:-1]
                entries[:, 1] = 4 * (np.diff(starts) - 4)
                entries[:, 2] = ids + np.cumsum(counts) - counts
                index.write(entries.tobytes())
                offset, ids, records = offset + 4 * int(starts[-1]), ids + int(counts.sum()), records + len(counts)
        return _Written(part, name, records, ids)

    def commit(self, messages: list) -> None:
        system, folder = _located(self.path)
        system.create_dir(folder)
        done = sorted((m for m in messages if m and m.records), key=lambda m: m.part)
        files = [{"name": m.name, "records": m.records, "ids": m.ids} for m in done]
        with system.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        """Nothing is listed, so nothing can be read; files of the attempts stay until the folder goes."""


class _File(InputPartition):
    def __init__(self, number: int, name: str, start: int):
        self.number, self.name, self.start = number, name, start


class RecordReader(DataSourceReader):
    def __init__(self, path: str, seed: int | None):
        self.path, self.seed = path, seed

    def partitions(self) -> list[InputPartition]:
        system, folder = _located(self.path)
        with system.open_input_stream(f"{folder}/{MANIFEST}") as listed:
            files = json.loads(listed.read())
        starts = np.cumsum([0, *(f["ids"] for f in files)]).tolist()
        parts = [_File(i, f["name"], starts[i]) for i, f in enumerate(files)]
        if self.seed is not None:
            parts = [parts[i] for i in np.random.default_rng(self.seed).permutation(len(parts))]
        return parts or [_File(0, "", 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        system, folder = _located(self.path)
        with system.open_input_stream(f"{folder}/{partition.name}.idx") as listed:
            index = np.frombuffer(listed.read(), dtype="<u8").reshape(-1, _INDEX).astype(np.int64)
        if self.seed is not None:
            index = index[np.random.default_rng([self.seed, partition.number]).permutation(len(index))]
        with system.open_input_file(f"{folder}/{partition.name}.rec") as data:
            low = 0
            while low < len(index):
                sizes = index[low : low + 1000, 1] + 16
                high = low + max(1, int(np.searchsorted(np.cumsum(sizes), READ_BYTES, side="right")))
                held = index[low:high]
                yield self._batch(data, held, partition.start)
                low = high

    def _batch(self, data, held: np.ndarray, start: int) -> pa.RecordBatch:
        sizes = held[:, 1] + 16
        if (held[1:, 0] == held[:-1, 0] + sizes[:-1]).all():  # one after the other
            raw = data.read_at(int(sizes.sum()), int(held[0, 0]))
        else:
            raw = b"".join(data.read_at(int(size), int(at)) for at, size in zip(held[:, 0], sizes))
        starts = (np.cumsum(sizes) - sizes) // 4
        doc_ids, ids = unframed(np.frombuffer(raw, dtype="<u4"), starts, held[:, 1] // 4 - 3)
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(start + held[:, 2], pa.int64()), ids], names=["doc_id", "start", "ids"])


class RecordFiles(DataSource):
    """Read: doc_id, start (ids of all records before) and ids. Options: path; seed, for records in a shuffled order."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "doc_id long, start long, ids array<int>"

    def reader(self, schema) -> RecordReader:
        seed = self.options.get("seed")
        return RecordReader(self.options["path"], None if seed is None else int(seed))

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"])


def write_records(encoded: DataFrame, path: str) -> None:
    """doc_id and ids of each row, in the order of the partitions and rows, as files below `path`, a new folder."""
    spark = encoded.sparkSession
    small_batches(spark)
    spark.dataSource.register(RecordFiles)
    encoded.select("doc_id", "ids").write.format(FORMAT).mode("append").save(path)


def read_records(spark: SparkSession, path: str, seed: int | None = None) -> DataFrame:
    """Records with their start. With a seed, files and the records of each file come in a shuffled order."""
    spark.dataSource.register(RecordFiles)
    reader = spark.read.format(FORMAT)
    return (reader if seed is None else reader.option("seed", seed)).load(path)


# ------------------------------------------------------------------------- ids

#: Words a worker remembers, and the longest of them.
MEMORY_WORDS, MEMORY_CHARS = 500_000, 40

_BLANKS_APART = re.compile("[^ \t\n\r\x0b\x0c]+")
#: White space for Python but not for the tokenizer.
_ODD_BLANKS = re.compile("[\x1c-\x1f]")
# Letters without marks to be composed and with one lower case: Latin, Cyrillic, Han, kana, Hangul syllables.
_LOWER_LETTERS = "a-zß-öø-ÿа-яё一-鿿ぁ-ゖァ-ヺ가-힣"
_SIMPLE = re.compile(f"[!-~À-ÖØ-ÞА-ЯЁ{_LOWER_LETTERS} \t\n\r\x0b\x0c]*")
# The tokenizer's split pattern for texts of such signs, lower-cased.
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LOWER_LETTERS}]+|[0-9]|[^0-9{_LOWER_LETTERS} \t\n\r\x0b\x0c]+")


def _byte_signs() -> list[str]:
    """The sign that byte-level pieces have for each byte: itself if it is printable Latin-1, else the next unused one."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    signs = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [signs[b] for b in range(256)]


class _Words(dict):
    """Ids of words, as bytes of unsigned integers, worked out when first asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        found = self.make(word)
        if len(word) <= MEMORY_CHARS:
            if len(self) >= MEMORY_WORDS:
                self.clear()
            self[word] = found
        return found


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space and never joins what it separates.

    The pieces of texts of simple signs go to the library's model. Other texts are cut at white space, and words that are
    not simple go through the whole tokenizer, as they are not known to be lower-cased, composed and split alike.
    Pieces and words that have been met are remembered. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.words, self.pieces = _Words(self._word), _Words(self._piece)
        self.signs = _byte_signs()

    def _bytes(self, ids: list[int]) -> bytes:
        return array("H" if self.kind.itemsize == 2 else "I", ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join([self.signs[b] for b in piece.encode()])
        return self._bytes([t.id for t in self.model.tokenize(shown)])

    def _simple(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        if _SIMPLE.fullmatch(word):
            return self._simple(word)
        return self._bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def encode(self, text: str) -> np.ndarray:
        if _SIMPLE.fullmatch(text):
            return np.frombuffer(self._simple(text), dtype=self.kind)
        words = _BLANKS_APART.findall(text) if _ODD_BLANKS.search(text) else text.split()
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)), dtype=self.kind)


_ENCODERS: dict[str, WordEncoder] = {}  # of this Python worker


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id and ids of each text, the end id last. The tokenizer file is read by each worker."""

    def make():
        encoder = _encoder(path)

        def run(batch: pa.RecordBatch) -> list:
            lists = [np.append(encoder.encode(t), end_id).astype(np.int32) for t in strings(batch, "text")]
            ends = pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())
            return [batch.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(lists)))]

        return run

    return map_rows(texts(docs), "doc_id long, ids array<int>", make)


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id and text in ascending order of doc_id over all partitions."""
    order = ["doc_id", "__text", "__at"]
    placed = texts(docs).select("doc_id", "text", F.xxhash64("text").alias("__text"), F.monotonically_increasing_id().alias("__at"))
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def digests(records: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of all ids (little-endian, four bytes each) of each record."""

    def make():
        def run(batch: pa.RecordBatch) -> list:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            data = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
            return [batch.column("doc_id"), batch.column("start"), np.diff(offsets).astype(np.int64), crc]

        return run

    return map_rows(records.select("doc_id", "start", "ids"), "doc_id long, start long, n_tokens long, ids_crc32 long", make)


def op13_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "records")
    write_records(encode(in_order(table(spark, sf_dir, "documents")), public_tokenizers.path("word_bpe_49k.json")), path)
    return digests(read_records(spark, path))
