"""Language identification by a string kernel.

The kernel of two texts counts the byte n-grams of one to three that both hold (a blended spectrum of presences),
divided by the geometric mean of their own counts. Grams are hashed to a fixed number of places. Landmark texts of
every language give the Nyström approximation; on its features one ridge regression per language is solved against
the others. Texts are scored in batches: presences times landmarks, then features times weights.

Learning takes at most PER_LANGUAGE texts of each language (those first by hash of their id), of which LANDMARKS are
landmarks; whole texts are used throughout. The landmarks' presence bits and the kernel rows of the sample reach the
driver: both bounded by these parameters times the number of languages.

Cases: a null or empty text and one without any letter is `und` with score 0. With one language every other text gets
it, with none learnt all are `und`. Ids, source and lang are never inputs of a prediction. Repeated rows are predicted
alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echowire.llm.frames import map_rows, strings, table
from echowire.session import stored

PLACES = 1 << 14
PER_LANGUAGE = 1000
LANDMARKS = 24
RIDGE = 1e-3
#: Code points of a text that are turned into grams at once.
PIECE = 1 << 20
UNKNOWN = "und"

_HASH = np.uint32(0x9E3779B1)
_SHIFT = np.uint32(32 - PLACES.bit_length() + 1)


def _grams(text: str, out: np.ndarray) -> None:
    """Mark the places of the grams of one text."""
    for at in range(0, max(1, len(text)), PIECE):
        # two more characters, so that no gram is lost between pieces
        piece = text[at : at + PIECE + 2].lower().encode("utf-8", "replace")
        one = np.frombuffer(piece, np.uint8).astype(np.uint32)
        out[((one + np.uint32(1)) * _HASH) >> _SHIFT] = 1
        two = (one[:-1] << np.uint32(8)) + one[1:]
        out[((two + np.uint32(1 << 16)) * _HASH) >> _SHIFT] = 1
        three = (two[:-1] << np.uint32(8)) + one[2:]
        out[((three + np.uint32(1 << 25)) * _HASH) >> _SHIFT] = 1


def presences(texts: list[str]) -> np.ndarray:
    """0/1 rows of gram presences."""
    out = np.zeros((len(texts), PLACES), dtype=np.float32)
    for row, text in zip(out, texts):
        _grams(text, row)
    return out


def kernel(held: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of two sets of rows."""
    own = np.sqrt(np.maximum(held.sum(1), 1))
    return (held @ landmarks.T) / own[:, None] / np.sqrt(np.maximum(landmarks.sum(1), 1))[None, :]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Model:
    def __init__(self, names: list[str], landmarks: np.ndarray, features: np.ndarray, weights: np.ndarray):
        self.names, self.bits = names, np.packbits(landmarks.astype(bool), axis=1)
        self.weights = (features @ weights[:-1]).astype(np.float32)
        self.shift = weights[-1].astype(np.float32)

    def scorer(self):
        """A function from texts to (language, score)."""
        landmarks = np.unpackbits(self.bits, axis=1, count=PLACES).astype(np.float32)

        def score(texts: list[str | None]) -> tuple[list[str], list[float]]:
            values = kernel(presences([t or "" for t in texts]), landmarks) @ self.weights + self.shift
            best = values.argmax(1)
            share = np.exp(8 * (values - values.max(1, keepdims=True)))
            share = 1 / share.sum(1)
            names = [self.names[b] if t and has_letter(t) else UNKNOWN for b, t in zip(best, texts)]
            return names, [float(s) if n != UNKNOWN else 0.0 for s, n in zip(share, names)]

        return score


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))


def picked_ids(known: DataFrame, per_language: int) -> DataFrame:
    """doc_id, lang and place of the first `per_language` ids of each language by hash.

    Ids are passed over in the tasks that read them unless their hash lies in the lowest part that should hold half as many
    again as are wanted, so few are shuffled and ranked. A language that has too few there, as its ids repeat, is
    taken whole instead.
    """
    ids, spark = known.select("doc_id", "lang"), known.sparkSession
    shares = {r["lang"]: min(1.0, (1.5 * per_language + 100) / r["count"]) for r in ids.groupBy("lang").count().collect()}
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    while True:
        # one row per language, as in the model
        limits = spark.createDataFrame([(n, -(2.0**63) + x * 2.0**64) for n, x in shares.items()], "lang string, below double")
        low = ids.join(F.broadcast(limits), "lang").where(F.xxhash64("doc_id").cast("double") <= F.col("below"))
        placed = stored(low.select("doc_id", "lang").distinct(), "language-ids")
        counts = {r["lang"]: r["count"] for r in placed.groupBy("lang").count().collect()}
        short = [n for n, x in shares.items() if x < 1 and counts.get(n, 0) < per_language]
        if not short:
            return placed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language)
        shares |= dict.fromkeys(short, 1.0)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """A model of the languages of documents that are not held out; None without any."""
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out())
    picked = stored(picked_ids(known, per_language), "language-sample")
    sample = known.select("doc_id", "text").join(picked, "doc_id")
    sample = stored(sample.select("lang", "place", "text"), "language-texts")

    marks = map_rows(
        sample.where(F.col("place") <= landmarks), "lang string, bits binary",
        lambda: lambda batch: [batch.column("lang"), [r.tobytes() for r in np.packbits(presences(strings(batch, "text")).astype(bool), axis=1)]],
    ).orderBy("lang", "bits").collect()
    if not marks:
        return None
    bits = np.stack([np.frombuffer(r["bits"], np.uint8) for r in marks])
    base = np.unpackbits(bits, axis=1, count=PLACES).astype(np.float32)

    def make():
        def run(batch: pa.RecordBatch) -> list:
            held = np.unpackbits(bits, axis=1, count=PLACES).astype(np.float32)
            rows = kernel(presences(strings(batch, "text")), held)
            return [batch.column("lang"), [r.astype("<f4").tobytes() for r in rows]]

        return run

    found = map_rows(sample.select("lang", "text"), "lang string, row binary", make).orderBy("lang", "row").collect()
    rows = np.stack([np.frombuffer(r["row"], "<f4") for r in found]).astype(float)
    names = sorted({r["lang"] for r in found})
    target = np.array([[float(r["lang"] == n) for n in names] for r in found])
    values, vectors = np.linalg.eigh(kernel(base, base).astype(float))
    good = values > 1e-6 * values.max()
    features = vectors[:, good] / np.sqrt(values[good])
    z = np.hstack([rows @ features, np.ones((len(rows), 1))])
    penalty = ridge * len(rows) * np.eye(z.shape[1])
    penalty[-1, -1] = 0
    weights = np.linalg.solve(z.T @ z + penalty, z.T @ target)
    return Model(names, base, features, weights)


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""

    def make():
        score = model.scorer() if model else lambda texts: ([UNKNOWN] * len(texts), [0.0] * len(texts))

        def run(batch: pa.RecordBatch) -> list:
            names, scores = score(strings(batch, "text"))
            return [batch.column("doc_id"), batch.column("held_out"), names, scores]

        return run

    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return map_rows(rows, "doc_id long, held_out boolean, lang_pred string, score double", make)


def op7_kernel_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predicted(docs, train(docs))
