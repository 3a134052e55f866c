"""Cosine similarity of two vector columns, and the hook for a text encoder."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

Encoder = Callable[[Sequence[str]], np.ndarray]

#: Bytes of texts that an encoder gets at once.
PIECE_BYTES = 4 << 20

# Task functions travel with their helpers, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lengths_of(vectors: pa.Array) -> np.ndarray:
    """Length of each vector, -1 for NULL."""
    return pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)


def matrix_of(vectors: pa.Array, rows: np.ndarray, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """The given rows, all of one length, as doubles, and which of them have no NULL inside."""
    flat = vectors.take(pa.array(rows)).flatten()
    shape = (len(rows), dimension)
    whole = np.ones(len(rows), dtype=bool)
    if flat.null_count:
        whole = ~pc.is_null(flat).to_numpy(zero_copy_only=False).reshape(shape).any(axis=1)
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(shape), whole


def _cosines(left: pa.Array, right: pa.Array) -> pa.Array:
    lengths = lengths_of(left)
    comparable = (lengths == lengths_of(right)) & (lengths >= 0)
    scores, usable = np.zeros(len(left)), np.zeros(len(left), dtype=bool)
    for dimension in np.unique(lengths[comparable]).tolist():
        rows = np.flatnonzero(comparable & (lengths == dimension))
        (a, whole_a), (b, whole_b) = (matrix_of(v, rows, dimension) for v in (left, right))
        with np.errstate(all="ignore"):
            norms = np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b))
            cosine = np.einsum("ij,ij->i", a, b) / np.where(norms == 0, 1.0, norms)
        scores[rows] = np.where(cosine > 0, cosine, 0.0)
        usable[rows] = whole_a & whole_b
    return pa.array(scores, mask=~usable)


def cosine_score(vector_1: Column, vector_2: Column) -> Column:
    """Cosine, not below 0; 0.0 for a zero vector or NaN; NULL where it cannot be computed,
    which is for a NULL vector, a NULL inside one, or different dimensions.

    An Arrow batch is one pass of array arithmetic, several times faster than array functions
    that evaluate a lambda per element.
    """

    @F.arrow_udf("double")
    def cosines(left: pa.Array, right: pa.Array) -> pa.Array:
        return _cosines(left, right)

    return cosines(vector_1, vector_2)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive parts of about PIECE_BYTES of UTF-8; a longer text is a part of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + PIECE_BYTES, side="right")))
        yield texts.slice(start, end - start)
        start = end


def encoded(text: Column, load_encoder: Callable[[], Encoder], dimension: int) -> Column:
    """Vectors from a user-supplied encoder, loaded once per task; zeros for empty text.

    The encoder gets the texts of an Arrow batch in parts of bounded size, so however long texts are, no more than one
    part of them is held as Python strings.
    """

    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = load_encoder()
        for texts in batches:
            vectors = np.zeros((len(texts), dimension), dtype=np.float32)
            start = 0
            for part in _slices(texts):
                filled = pc.fill_null(pc.not_equal(part, ""), False)
                rows = start + np.flatnonzero(filled.to_numpy(zero_copy_only=False))
                if len(rows):
                    vectors[rows] = encoder(part.filter(filled).to_pylist())
                start += len(part)
            ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * dimension)
            yield pa.ListArray.from_arrays(ends, pa.array(vectors.ravel()))

    return encode(text)
