"""Repair of conversation structure at least cost, over a suffix-shared automaton.

Each row of a conversation is one sign: its role (s, u, a or another) and its first fault. The signs of a conversation
are its signature. Signatures of all conversations are sorted from their ends, so conversations that end alike follow
each other and share the nodes of their common suffix: a task holds the path of the current signature, drops the
nodes that the next one does not share, and works out cost-to-go and best audit suffix once for each new node and
grammar state. Rows whose role and text stand earlier in the conversation are duplicates.

Roles must read `(s?(ua)+)?` after the edits. Keep costs nothing, Rerole (to user or assistant) 2, Delete 3 and Insert of an
empty user or assistant 2; blank and duplicate rows must go, and a truncated row that stays costs 1. Of equally cheap
audits the least in ASCII order is taken; it fixes all edits.

Audits are compared without being written out: two candidates differ in their letters up to the next row or, if not, by
the ranks of their tails among the states of the next node. Only equal vectors of costs and ranks lead to equal
nodes, so the few vectors there are, with what each sign makes of them, are remembered.

Order: rows by turn (null first), rows of one turn by the SHA-256 of role and text; equal rows are interchangeable.

Size: rows are range-partitioned by conversation, turn and hash, so a conversation of any length is spread over
partitions; signatures are joined from pieces of at most PIECE rows. A signature and an audit have one letter for each row.
Repaired rows leave a task as a stream; only a digest of a whole conversation is made by one task, in constant memory.

Cases: a null role or text is one space. Rows with a null conv_id are one conversation. Conversations whose rows are all
gone have figures of zero. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from echowire.llm.frames import small_batches, table
from echowire.operators.skew import attach
from echowire.session import stored

#: Rows of different content in a piece of a signature, as a power of two.
PIECE_BITS = 12
#: Signs at the end of a signature that place it in a partition; rows of a partition are sorted by whole signatures.
PLACING = 48

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

_BLANK = " \t\n\x0b\x0c\r"
_MUST_GO = "-"

# ------------------------------------------------------------------------- automaton

#: Grammar states: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {(START, "s"): SYSTEM, **{(q, "u"): USER for q in (START, SYSTEM, ASSISTANT)}, (USER, "a"): ASSISTANT}
_NAMES = {"u": "user", "a": "assistant"}

#: A node: cost-to-go and rank of the best audit suffix for each grammar state.
Vector = tuple[tuple[int, ...], tuple[int, ...]]
#: The best edits at a node for each grammar state: letters, and the state after them.
Choice = tuple[tuple[str, int], ...]

_END_LETTERS = ("", "II", "I", "")


def _ranks(keys: list) -> tuple[int, ...]:
    places = {key: i for i, key in enumerate(sorted(set(keys)))}
    return tuple(places[key] for key in keys)


END: Vector = (tuple(INSERT * len(x) for x in _END_LETTERS), _ranks(list(_END_LETTERS)))


def _row_edits(sign: str, state: int) -> Iterator[tuple[int, str, int]]:
    """Cost, letter and next state of each edit of a row."""
    yield DELETE, "D", state
    if sign == _MUST_GO:
        return
    kept = TRUNCATED if sign.isupper() else 0
    if (state, sign.lower()) in _NEXT:
        yield KEEP + kept, "K", _NEXT[state, sign.lower()]
    for role in "ua":
        if (state, role) in _NEXT:
            yield REROLE + kept, "R", _NEXT[state, role]


def _inserted(state: int) -> list[tuple[str, int]]:
    """Letters and states before a row: more than two inserted rows lead back to where one or none leads."""
    out = [("", state)]
    for _ in range(2):
        letters, at = out[-1]
        out.append((letters + "I", _NEXT[at, "a" if at == USER else "u"]))
    return out


@cache
def step(sign: str, after: Vector) -> tuple[Vector, Choice]:
    """The node before a row, from the node after it. The number of different vectors does not grow with the input."""
    costs, ranks = after
    best = []
    for state in range(4):
        candidates = []
        for letters, at in _inserted(state):
            for cost, letter, then in _row_edits(sign, at):
                whole = INSERT * len(letters) + cost + costs[then]
                candidates.append((whole, letters + letter, ranks[then], then))
        best.append(min(candidates))
    low = min(b[0] for b in best)
    vector = (tuple(b[0] - low for b in best), _ranks([b[1:3] for b in best]))
    return vector, (low, tuple((b[1], b[3]) for b in best))


class Automaton:
    """The path of the current signature, from its end; nodes shared with the one before are not worked out again."""

    def __init__(self):
        self.signature = ""  # from its end
        self.vectors = [END]
        self.choices: list[Choice] = []
        self.low = [0]
        self.made = 0  # nodes so far

    def visit(self, signature: str) -> tuple[int, list[str], list[int]]:
        """Cost, the letters of each row (and those after the last), and the state before each row."""
        backwards = signature[::-1]
        shared = _shared(self.signature, backwards)
        del self.vectors[shared + 1 :], self.choices[shared:], self.low[shared + 1 :]
        for sign in backwards[shared:]:
            vector, (low, choice) = step(sign, self.vectors[-1])
            self.vectors.append(vector)
            self.choices.append(choice)
            self.low.append(self.low[-1] + low)
            self.made += 1
        self.signature = backwards
        state, letters, states = START, [], []
        for choice in reversed(self.choices):
            states.append(state)
            chosen, state = choice[states[-1]]
            letters.append(chosen)
        letters.append(_END_LETTERS[state])
        return self.low[-1] + self.vectors[-1][0][START], letters, states


def _shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


# ------------------------------------------------------------------------- rows


def _named(conversations: DataFrame) -> DataFrame:
    """Rows with a key that is never null, and the hash that orders rows of one turn."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(" "))

    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        known("role").alias("role"), known("text").alias("text"),
    )
    return rows.withColumn("hash", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def signed(rows: DataFrame) -> DataFrame:
    """One row for each conversation, turn and content: number of equal rows, role sign, faults, and `pos`, which ascends
    through each conversation."""
    initial = F.substring("role", 1, 1)
    last = F.substring(F.rtrim("text", F.lit(_BLANK)), -1, 1)
    facts = rows.select(
        "conv", "turn", "hash", F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("role"),
        (last == "").alias("blank"), (~last.isin("", ".", "!", "?")).alias("cut"),
    )
    facts = facts.groupBy(*facts.columns).agg(F.count("*").alias("copies"))
    firsts = facts.groupBy("conv", "hash").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n"))
    marked = attach(facts, firsts, ["conv", "hash"], ["turn"], size="n")
    marked = marked.withColumn("again", ~F.col("first.turn").eqNullSafe(F.col("turn"))).drop("first", "n")
    order = ["conv", "turn", "hash"]
    placed = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(placed.withColumn("pos", F.monotonically_increasing_id()), "signed-rows")


def _pairs(name: str, test) -> Column:
    """How many neighbours in an array pass a test; the first entry has none before it."""
    return F.size(F.filter(name, lambda x, i: F.coalesce(test(F.get(F.col(name), i - 1), x), F.lit(False)) & (i > 0))).cast("long")


def _legal(before: Column, after: Column) -> Column:
    return F.concat(before, after).isin("su", "ua", "au")


def conversation_figures(rows: DataFrame) -> DataFrame:
    """Per conversation, from `signed` rows: the signature in pieces, faults, gaps and role changes that do not fit."""
    fault = F.when(F.col("blank"), "blank").when(F.col("again"), "duplicate").when(F.col("cut"), "truncated")
    more = F.when(F.col("blank"), "blank").otherwise("duplicate")
    sign = F.when(F.col("blank") | F.col("again"), _MUST_GO).when(F.col("cut"), F.upper("role")).otherwise(F.col("role"))
    copies = F.col("copies")
    rest = (copies - 1).cast("int")
    entry = F.struct(
        "pos", "turn", "hash", "role", F.concat(sign, F.repeat(F.lit(_MUST_GO), rest)).alias("signs"),
    )

    def faults(kind: str) -> Column:
        return F.sum(F.when(fault == kind, 1).otherwise(0) + F.when(more == kind, copies - 1).otherwise(0)).alias(kind)

    pieces = rows.groupBy("conv", F.shiftright("pos", PIECE_BITS).alias("piece")).agg(
        F.array_sort(F.collect_list(entry)).alias("rows"), F.sum("copies").alias("n"),
        *(faults(kind) for kind in ("blank", "duplicate", "truncated")),
    )
    first, last = F.element_at("rows", 1), F.element_at("rows", -1)
    pieces = pieces.select(
        "conv", "n", "blank", "duplicate", "truncated", F.struct(
            "piece", F.array_join(F.transform("rows", lambda r: r.signs), "").alias("signs"),
            F.size("rows").alias("contents"), first.turn.alias("turn"), first.hash.alias("hash"), first.role.alias("role"),
            last.turn.alias("last_turn"), last.role.alias("last_role"),
        ).alias("part"),
        _pairs("rows", lambda a, b: _legal(a.role, b.role)).alias("legal"),
        (F.size(F.filter("rows", lambda r: r.turn.isNotNull())) - _pairs("rows", lambda a, b: a.turn == b.turn)).alias("turns"),
        F.array_max(F.transform("rows", lambda r: r.turn)).alias("high"), F.array_min(F.transform("rows", lambda r: r.turn)).alias("low"),
    )
    whole = pieces.groupBy("conv").agg(
        F.array_sort(F.collect_list("part")).alias("parts"), F.max("high").alias("high"), F.min("low").alias("low"),
        *(F.sum(c).alias(c) for c in ("n", "blank", "duplicate", "truncated", "legal", "turns")),
    )
    turns = F.col("turns") - _pairs("parts", lambda a, b: a.last_turn == b.turn)
    legal = F.col("legal") + _pairs("parts", lambda a, b: _legal(a.last_role, b.role))
    return whole.select(
        "conv", "parts", F.coalesce(F.col("high") - F.col("low") + 1 - turns, F.lit(0)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", (F.col("n") - 1 - legal).alias("illegal"),
    )


_AUDITED = (
    "conv string, cost long, audit string, nodes long, "
    "edits array<struct<turn: long, hash: binary, state: int, letters: array<string>>>"
)


def audits(figures: DataFrame) -> DataFrame:
    """conv, cost, audit, and the edits of each piece of the signature: where it starts, the grammar state there, and the
    letters of each row (the last piece has those after the last row too). `nodes` were made for the conversation."""
    schema = StructType.fromDDL(_AUDITED)
    arrow = to_arrow_schema(schema)
    small_batches(figures.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            out = []
            for conv, parts in zip(batch.column("conv").to_pylist(), batch.column("parts").to_pylist()):
                made = automaton.made
                cost, letters, states = automaton.visit("".join(p["signs"] for p in parts))
                edits, at = [], 0
                for i, p in enumerate(parts):
                    end = at + len(p["signs"])
                    own = letters[at : end + (i == len(parts) - 1)]
                    edits.append({"turn": p["turn"], "hash": p["hash"], "state": states[at], "letters": own})
                    at = end
                out.append((conv, cost, "".join(letters), automaton.made - made, edits))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    backwards = F.reverse(F.array_join(F.transform("parts", lambda p: p.signs), ""))
    rows = figures.select("conv", "parts", backwards.alias("__back"))
    # Conversations of one signature are spread too; each partition works out the nodes of its first signature anew.
    placed = rows.repartitionByRange(F.substring("__back", 1, PLACING), "conv").sortWithinPartitions("__back", "conv")
    return placed.select("conv", "parts").mapInArrow(run, schema)


# ------------------------------------------------------------------------- repaired rows


def _placed(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Rows of each conversation in order; the edits of each piece come right before its first row."""
    edits = audited.select("conv", F.explode("edits").alias("edit"))
    edits = edits.select(
        "conv", "edit.turn", "edit.hash", F.lit(0).alias("kind"), F.lit("").alias("role"), F.lit("").alias("text"),
        "edit.state", "edit.letters",
    )
    texts = rows.select(
        "conv", "turn", "hash", F.lit(1).alias("kind"), "role", "text", F.lit(None).cast("int").alias("state"),
        F.lit(None).cast("array<string>").alias("letters"),
    )
    both = edits.unionByName(texts)
    return both.repartition("conv").sortWithinPartitions("conv", "turn", "hash", "kind").select(
        "conv", "kind", "role", "text", "state", "letters")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str]]:
    """Conversation, role and text of the repaired rows, read as a stream."""
    letters: list[str] = []
    at, state = 0, START

    def applied(conv: str, edits: str, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        nonlocal state
        for letter in edits:
            if letter == "D":
                continue
            if letter == "K":
                state = _NEXT[state, role[:1]]
                yield conv, role, text
                continue
            new = "a" if state == USER else "u"
            state = _NEXT[state, new]
            yield conv, _NAMES[new], text if letter == "R" else ""

    held = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "kind", "role", "text", "state", "letters")]
        for conv, kind, role, text, state_, letters_ in zip(*columns):
            if not kind:
                if held is not None and at < len(letters):
                    yield from applied(held, letters[at], "", "")  # what is inserted after the last row
                letters, at, state, held = letters_, 0, state_, conv
                continue
            yield from applied(conv, letters[at], role, text)
            at += 1
    if held is not None and at < len(letters):
        yield from applied(held, letters[at], "", "")


def repaired_rows(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """conv, position (from 0), role and text of the repaired conversations."""
    schema = StructType.fromDDL("conv string, position long, role string, text string")
    arrow = to_arrow_schema(schema)
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, position, out = None, 0, []
        for conv, role, text in _edited(batches):
            position = position + 1 if conv == current else 0
            current = conv
            out.append({"conv": conv, "position": position, "role": role, "text": text})
            if len(out) >= 512:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return _placed(rows, audited).mapInArrow(run, schema)


def repaired_digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """conv and repaired_sha256: SHA-256 of the repaired `role:text` lines; conversations without such rows are left out."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for conv, role, text in _edited(batches):
            if conv != current:
                if digest:
                    yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])
                current, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])

    return _placed(rows, audited).mapInArrow(run, "conv string, repaired_sha256 string")


def repair_report(original: DataFrame, rows: DataFrame) -> DataFrame:
    """Every conv_id of `original` with faults, cost, audit and digest of the repair of `rows`."""
    rows = _named(rows)
    figures = stored(conversation_figures(signed(rows)), "conversation-figures")
    audited = stored(audits(figures), "audits")
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    ids = original.select("conv_id", conv.alias("conv")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = ids.join(figures.drop("parts"), "conv", "left").join(audited.drop("edits"), "conv", "left")
    whole = whole.join(repaired_digests(rows, audited), "conv", "left")
    return whole.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        F.coalesce("nodes", F.lit(0)).cast("long").alias("nodes"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user by the checksum of `conv_id:turn`."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))), F.lit(20))
    rows = conversations.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(conversations, damaged(conversations))
