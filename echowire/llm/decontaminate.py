"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are brought to one normal form: lower case, runs of anything but letters and digits as one blank. An
item of m bytes may differ from a passage by a budget of k edits. It is cut into k + 1 pieces, so a passage within the
budget holds at least one piece unchanged. All pieces of all items are looked for in one pass by an
automaton; around each hit the whole item is matched with Myers' bit-parallel edit distance. Windows of hits that overlap
are matched once.

The automaton grows with the test items, not with the documents. Items are taken in slices of at most SLICE_BYTES of
normal form, one pass each, so what a task holds is bounded whatever the size of the benchmark.

Forms shorter than SHORT_BYTES count only at word borders: where such an item begins or ends with a word, the passage
does too. Scripts written without blanks have no such borders. If signs make up much of the text of a short item, as in
code and formulas, the signs are kept, in the item and in the texts it is looked for in.

Cases: null or empty texts hold nothing. An item without any sign, letter or digit is left out, as is a null item. Equal items each report. Repeated documents each report. An empty table on either side gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echowire.llm.frames import map_rows, strings, table, texts
from echowire.session import stored

#: Edits for each byte of an item's normal form.
EDIT_SHARE = 0.08
#: Bytes that a form has at least.
MIN_BYTES = 1
#: Bytes below which a form is matched at word borders.
SHORT_BYTES = 24
#: Share of a short item's text below which its normal form is too little of it, so that signs are kept.
SIGNED_SHARE = 0.75
#: Normal-form bytes of the items that one pass looks for.
SLICE_BYTES = 8_000_000

_KEEP = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_SIGNED = bytes(0x20 if b <= 0x20 or b == 0x7F else b for b in range(256))
_AROUND = re.compile(rb" ?([!-/:-@\[-`{-~]) ?")
#: Scripts that are written without blanks: Thai to Lao, Myanmar, Khmer, kana, Han.
_NO_BLANKS = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff00-\uff9f\U00020000-\U0003ffff]"
)


def normal_form(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode("utf-8", "replace").translate(_KEEP).split())


def signed_form(text: str | None) -> bytes:
    """Lower case with signs; blanks are kept, as one, between words only."""
    return _AROUND.sub(rb"\1", b" ".join((text or "").lower().encode("utf-8", "replace").translate(_SIGNED).split()))


def form_of_item(text: str | None) -> tuple[bytes, bool]:
    """The form in which an item is looked for, and whether it keeps signs."""
    form = normal_form(text)
    if len(form) < SHORT_BYTES:
        signed = signed_form(text)
        if len(form) < SIGNED_SHARE * len(signed):
            return signed, True
    return form, False


def _in_word(char: str) -> bool:
    """Whether a character belongs to a word that has borders."""
    return char.isascii() and char.isalnum() or char > "\x7f" and not _NO_BLANKS.match(char)


def _first(part: bytes) -> str:
    return part[:4].decode("utf-8", "ignore")[:1]


def _last(part: bytes) -> str:
    return part[-4:].decode("utf-8", "ignore")[-1:]


def edit_distance(a: bytes, b: bytes) -> int:
    row = list(range(len(a) + 1))
    for j, c in enumerate(b, 1):
        new = [j]
        for i, x in enumerate(a):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
    return row[-1]


def best_at_borders(item: bytes, text: bytes, start: int, budget: int) -> tuple[int, int] | None:
    """Smallest distance within the budget, and the end, of a passage near `start` that is not cut out of longer words."""
    first, last = _in_word(_first(item)), _in_word(_last(item))
    best = None
    for low in range(max(0, start - budget), min(start + budget, len(text)) + 1):
        if first and low and _in_word(_last(text[max(0, low - 4) : low])) and _in_word(_first(text[low : low + 4])):
            continue
        for high in range(max(low + 1, low + len(item) - budget), min(low + len(item) + budget, len(text)) + 1):
            if last and high < len(text) and _in_word(_first(text[high : high + 4])) and _in_word(_last(text[max(0, high - 4) : high])):
                continue
            found = (0 if text[low:high] == item else edit_distance(item, text[low:high]), high)
            if found[0] <= budget and (best is None or found < best):
                best = found
    return best


def pieces(item: bytes, budget: int) -> list[tuple[int, bytes]]:
    """Start and bytes of budget + 1 pieces of nearly equal size."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def best_match(item: bytes, text: bytes) -> tuple[int, int]:
    """Smallest edit distance of the item to any passage of the text, and the end of the first such passage.

    One step per byte of the text; the column of the distance matrix is held as two bit vectors.
    """
    m = len(item)
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    get = masks.get
    for at, c in enumerate(text):
        eq = get(c, 0)
        x = eq | minus
        d = ((((x & plus) + plus) ^ plus) | x) & full
        up, down = minus | (full & ~(d | plus)), plus & d
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full  # a passage may begin anywhere: row 0 stays 0
        down = (down << 1) & full
        plus = down | (full & ~(d | up))
        minus = up & d
        if score < best:
            best, end = score, at + 1
    return best, end


class Matcher:
    """Finds the items of one slice in normal forms."""

    def __init__(self, items: list[tuple[int, bytes]], share: float):
        self.items = [(i, item, int(len(item) * share)) for i, item in items]
        self.automaton = ahocorasick.Automaton()
        where: dict[bytes, list[tuple[int, int]]] = {}
        for n, (_, item, budget) in enumerate(self.items):
            for start, piece in pieces(item, budget):
                where.setdefault(piece, []).append((n, start + len(piece)))
        for piece, found in where.items():
            self.automaton.add_word(piece.decode("latin-1"), found)
        self.automaton.make_automaton()

    def find(self, text: bytes) -> list[tuple[int, int, int]]:
        """(item id, distance, end of the passage) of each item that the text holds within its budget."""
        if not self.items or not text:
            return []
        windows: dict[int, list[list[int]]] = {}
        short: dict[int, tuple[int, int]] = {}
        tried: set[tuple[int, int]] = set()
        for last, found in self.automaton.iter(text.decode("latin-1")):
            for n, offset in found:
                _, item, budget = self.items[n]
                start = last + 1 - offset
                if len(item) < SHORT_BYTES:
                    if short.get(n, (1, 0))[0] and (n, start) not in tried:
                        tried.add((n, start))
                        at = best_at_borders(item, text, start, budget)
                        if at and at < short.get(n, (budget + 1, 0)):
                            short[n] = at
                    continue
                low, high = max(0, start - budget), start + len(item) + budget
                held = windows.setdefault(n, [])
                if held and low <= held[-1][1]:
                    held[-1][1] = max(held[-1][1], high)
                    held[-1][0] = min(held[-1][0], low)
                else:
                    held.append([low, high])
        out = [(self.items[n][0], *at) for n, at in short.items()]
        for n, spans in windows.items():
            key, item, budget = self.items[n]
            best = None
            for low, high in spans:
                distance, end = best_match(item, text[low:high])
                if distance <= budget and (best is None or distance < best[0]):
                    best = (distance, low + end)
            if best:
                out.append((key, *best))
        return out


def _slices(benchmark: DataFrame, slice_bytes: int) -> Iterator[list[tuple[int, bytes, bool]]]:
    """Forms, and whether they keep signs, of the items in slices of bounded size, read one slice after the other."""
    rows = benchmark.where("text IS NOT NULL").select("item_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // slice_bytes)
    for i in range(n):
        part = rows.where(F.expr(f"pmod(xxhash64(item_id, text), {n})") == i)
        items = [(r["item_id"], *form_of_item(r["text"])) for r in part.orderBy("item_id", "text").collect()]
        yield [x for x in items if len(x[1]) >= MIN_BYTES]


def _found(docs: DataFrame, benchmark: DataFrame, share: float, slice_bytes: int) -> DataFrame:
    """The rows of `passages`, each with the hash of its document's text."""
    schema = "doc_id long, text_hash long, item_id long, distance int, budget int, end long"
    hashed = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    found = []
    for items in _slices(benchmark, slice_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(items)  # at most slice_bytes

        def make(shared=shared):
            matchers = []
            for form, signs in ((normal_form, False), (signed_form, True)):
                matcher = Matcher([(n, x[1]) for n, x in enumerate(shared.value) if x[2] == signs], share)
                if matcher.items:
                    matchers.append((form, matcher))
            budgets = {n: budget for _, matcher in matchers for n, _, budget in matcher.items}
            keys = [x[0] for x in shared.value]

            def run(batch: pa.RecordBatch) -> list:
                rows = []
                ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
                for doc, text_hash, text in zip(ids, hashes, strings(batch, "text")):
                    for form, matcher in matchers:
                        rows += [(doc, text_hash, keys[n], d, budgets[n], end) for n, d, end in matcher.find(form(text))]
                return list(zip(*rows)) if rows else [[]] * 6

            return run

        found.append(map_rows(hashed, schema, make))
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, found)


def passages(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, item_id, distance, budget and end (bytes of the form searched) for each item that a document holds."""
    return _found(docs, benchmark, share, slice_bytes).drop("text_hash")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE) -> DataFrame:
    """The documents that hold no test item, with all their columns.

    Rows are told apart by id and text: a clean row stays when another one of its id, or of no id, holds an item.
    """
    found = _found(docs, benchmark, share, SLICE_BYTES)
    found = stored(found.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(found["__doc"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["__hash"])
    return docs.join(found, same, "left_anti")


def op6_pigeonhole_decontamination(spark, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
