"""Byte-level BPE by a monoid tree: halves are encoded on their own and joined at their border.

An element is a text with its ids; joining two gives the ids of the joined text. The split pattern never matches
across a place where white space follows another sign, a letter follows a digit, a digit a letter, or punctuation either of them,
and its matches depend on nothing before that place. So in a join all tokens left of such a place in the left text and
right of one in the right text provably stay. A window around the border is grown until it reaches such a place on
both sides, or the end of the text, and only the window is encoded again. Decoding concatenates the bytes of both halves.

Leaves are short, so that all but short documents are joined; the result is the same for every leaf size.

Cases: a null or empty text gives no tokens. A text without any such place (one letter on end) is a window as a whole,
once on each level of the tree. Rows are independent; memory is bounded by one document and its ids. Repeated rows
give repeated results.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from echowire.llm.frames import map_rows, strings, texts

#: Code points, or ids, of a leaf of the tree; a leaf is encoded or decoded at once.
LEAF = 256
#: Code points looked at on each side of a border at first.
WINDOW = 24

_CUT = re.compile(
    r"(?<=\S)[ \n\t]|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z0-9一-鿿ぁ-ゖァ-ヺ가-힣])(?=[!-/:-@\[-`{-~、。，！？；：])"
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file; the path is read by the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Codec:
    """Encoder and decoder of one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF, window: int = WINDOW):
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.leaf, self.window = max(1, leaf), max(2, window)
        self.joins = 0  # so far

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.encoding.encode_ordinary(text)
        middle = len(text) // 2
        left, right = text[:middle], text[middle:]
        return self.join(left, self.encode(left), right, self.encode(right))

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """Ids of left + right from the ids of both."""
        if not left or not right:
            return left_ids + right_ids
        self.joins += 1
        start, end = self._start(left), self._end(right)
        if end == len(right):  # the right text has no stable place, so nothing of it is kept
            kept_right = []
        else:
            kept_right = right_ids[self._tokens(right_ids, right[:end]) :]
        kept_left = left_ids[: len(left_ids) - self._tokens(reversed(left_ids), left[start:])] if start else []
        return kept_left + self.encoding.encode_ordinary(left[start:] + right[:end]) + kept_right

    def _start(self, left: str) -> int:
        """Last stable place of the left text, or 0."""
        width = self.window
        while True:
            low = max(0, len(left) - width)
            places = [m.start() for m in _CUT.finditer(left, low)]
            if places:
                return places[-1]
            if low == 0:
                return 0
            width *= 4

    def _end(self, right: str) -> int:
        """First stable place of the right text, or its length."""
        width = self.window
        while True:
            found = _CUT.search(right, 1, width)
            if found:
                return found.start()
            if width >= len(right):
                return len(right)
            width *= 4

    def _tokens(self, ids: Iterable[int], part: str) -> int:
        """How many tokens, from the first on, make up as many bytes as `part` has."""
        size, n, ids = len(part.encode()), 0, iter(ids)
        while size > 0:
            size -= len(self.bytes_of[next(ids)])
            n += 1
        if size:
            raise AssertionError("a stable place lies inside a token")
        return n

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return self.encoding.decode_bytes(ids)
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def _codecs(spark: SparkSession, path: str, pattern: str, leaf: int, window: int):
    """A function that gives each worker its codec; the table has a fixed size of some 50,000 tokens and is broadcast."""
    ranks = spark.sparkContext.broadcast(read_ranks(path))

    def get() -> Codec:
        key = (path, pattern, leaf, window)
        if key not in _CODECS:
            _CODECS[key] = Codec(ranks.value, pattern, leaf, window)
        return _CODECS[key]

    return get


_CODECS: dict[tuple, Codec] = {}  # of this Python worker


def encode(docs: DataFrame, path: str, pattern: str, leaf: int = LEAF, window: int = WINDOW) -> DataFrame:
    """doc_id and ids (array<int>) of each text."""
    codec_of = _codecs(docs.sparkSession, path, pattern, leaf, window)

    def make():
        codec = codec_of()
        return lambda batch: [batch.column("doc_id"), [codec.encode(t) for t in strings(batch, "text")]]

    return map_rows(texts(docs), "doc_id long, ids array<int>", make)


def decode(encoded: DataFrame, path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """doc_id and bytes of each row of ids; null ids give no bytes."""
    codec_of = _codecs(encoded.sparkSession, path, pattern, leaf, WINDOW)

    def make():
        codec = codec_of()
        return lambda batch: [batch.column("doc_id"), [codec.decode(x or []) for x in batch.column("ids").to_pylist()]]

    return map_rows(encoded.select("doc_id", "ids"), "doc_id long, bytes binary", make)


def digests(
    docs: DataFrame, path: str, pattern: str, leaf: int = LEAF, window: int = WINDOW, with_ids: bool = False
) -> DataFrame:
    """Each text encoded and decoded again: n_tokens, and SHA-256 of the ids (decimal, comma-joined) and of the bytes.

    `with_ids` adds the ids.
    """
    codec_of = _codecs(docs.sparkSession, path, pattern, leaf, window)

    def make():
        codec = codec_of()
        names = {rank: str(rank) for rank in codec.bytes_of}

        def run(batch: pa.RecordBatch) -> list:
            n, ids_sha, decoded_sha, kept = [], [], [], []
            for text in strings(batch, "text"):
                ids = codec.encode(text)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                if with_ids:
                    kept.append(np.array(ids, dtype=np.int32))
            lists = []
            if with_ids:
                ends = np.cumsum([0, *n], dtype=np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(kept)))]
            return [batch.column("doc_id"), n, ids_sha, decoded_sha, *lists]

        return run

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(texts(docs), schema + ", ids array<int>" * with_ids, make)


def vocabulary() -> tuple[str, str]:
    """Path of the multilingual rank file and the split pattern that belongs to it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op9_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from echowire.llm.frames import table

    return digests(table(spark, sf_dir, "documents"), *vocabulary())
