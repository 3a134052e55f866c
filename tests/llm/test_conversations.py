"""Conversation repair against exhaustive edits and a plain run over each conversation."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from echowire.llm import conversation_repair as repair

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, conv string, hash int"


def exhaustive(signs):
    """Cheapest cost and least audit over all edits with at most two rows inserted in each place."""
    gaps = ["", "u", "a", "uu", "ua", "au", "aa"]
    best = None
    for inserts in itertools.product(gaps, repeat=len(signs) + 1):
        for edits in itertools.product("DKua", repeat=len(signs)):
            roles, audit, cost = inserts[0], "I" * len(inserts[0]), 2 * len(inserts[0])
            for sign, edit, more in zip(signs, edits, inserts[1:]):
                if edit != "D" and sign == "-":
                    break
                roles += {"D": "", "K": sign.lower()}.get(edit, edit) + more
                audit += ("R" if edit in "ua" else edit) + "I" * len(more)
                cost += {"D": 3, "K": 0}.get(edit, 2) + 2 * len(more) + (edit != "D" and sign.isupper())
            else:
                if (best is None or (cost, audit) < best) and re.fullmatch("(s?(ua)+)?", roles):
                    best = cost, audit
    return best


def found(signs, automaton=None):
    cost, letters, _ = (automaton or repair.Automaton()).visit(signs)
    return cost, "".join(letters)


def test_all_short_signatures():
    for n in range(3):
        for signs in itertools.product("suaoSUAO-", repeat=n):
            assert found("".join(signs)) == exhaustive(signs), signs


def test_some_longer_signatures():
    for signs in ("suu", "aSu", "o-a", "uUs", "usa"):
        assert found(signs) == exhaustive(signs), signs


def plain(signs):
    """Cost and audit by states from the end, with audits written out."""
    after = {0: (0, ""), 1: (4, "II"), 2: (2, "I"), 3: (0, "")}
    moves = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    for sign in reversed(signs):
        here = {}
        for q in range(4):
            options, letters, at = [], "", q
            for _ in range(3):
                edits = [(3, "D", at)]
                if sign != "-":
                    edits += [(0, "K", moves[at, sign.lower()])] if (at, sign.lower()) in moves else []
                    edits += [(2, "R", moves[at, r]) for r in "ua" if (at, r) in moves]
                for cost, letter, then in edits:
                    cost += (letter != "D" and sign.isupper()) + 2 * len(letters) + after[then][0]
                    options.append((cost, letters + letter + after[then][1]))
                letters, at = letters + "I", moves[at, "a" if at == 2 else "u"]
            here[q] = min(options)
        after = here
    return after[0]


def test_long_signatures_and_shared_nodes():
    rng = random.Random(5)
    whole = ["".join(rng.choices("suaoSUAO-", [1, 6, 6, 1, 1, 2, 2, 1, 2], k=rng.randint(0, 60))) for _ in range(300)]
    whole += ["s" + "ua" * 40, "ua" * 40, "a" + "ua" * 40, "ua" * 40]
    automaton = repair.Automaton()
    for signs in sorted(whole, key=lambda s: s[::-1]):
        assert found(signs, automaton) == plain(signs)
    assert automaton.made < sum(map(len, whole))  # suffixes are shared
    automaton, made = repair.Automaton(), []
    for signs in ("ua", "sua", "asua"):
        automaton.visit(signs)
        made.append(automaton.made)
    assert made == [2, 3, 4]


def expected(rows):
    """The report of damaged rows, conversation by conversation."""
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        grouped[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        grouped[conv] += [(turn, role, text)] * (1 + (kind == 3))
    out = {}
    for conv, held in grouped.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()))
        seen, signs, counts = set(), "", defaultdict(int)
        for _, role, text in held:
            body = text.rstrip(BLANKS)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            sign = role[:1] if role[:1] in ("s", "u", "a") else "o"
            signs += {"blank": "-", "duplicate": "-", "truncated": sign.upper(), "": sign}[fault]
        turns = {t for t, _, _ in held if t is not None}
        cost, audit = plain(signs)
        lines, rest, state = [], list(held), ""
        for letter in audit:
            if letter == "I":
                state = "a" if state == "u" else "u"
                lines.append({"u": "user:", "a": "assistant:"}[state])
                continue
            _, role, text = rest.pop(0)
            if letter == "R":
                role = "assistant" if state == "u" else "user"
            if letter != "D":
                state = role[:1]
                lines.append(f"{role}:{text}")
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def report(df):
    rows = repair.repair_report(df, repair.damaged(df)).collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in rows}


def made_rows(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 2, 3, 6, 9])):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "u2"])
            text = rng.choice(["Yes.", "No", "What?", " ", "", None, "é…", f"Row {turn}.", "ends \t\n", "x\u0085", "Done! \x0b"])
            rows.append((conv, rng.choice([turn, turn, turn, turn * 3, None, 2]), role, text))
    return rows


@pytest.mark.parametrize("piece_bits", [1, 12])
def test_report_equals_a_plain_run(spark, monkeypatch, piece_bits):
    monkeypatch.setattr(repair, "PIECE_BITS", piece_bits)
    rows = made_rows(150) + [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Yes")]
    rows += [(1000, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(3000)]  # one long conversation
    rows += [(1001, 7, "user", "Same.")] * 500 + [(1002, t, "user", "Same again.") for t in range(300)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA).repartition(6)
    assert report(df) == expected(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "What"), (2, 5, "user", "Long " * 50_000 + "."), (2, 6, "assistant", "Yes.")]
    named = repair._named(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    audited = repair.audits(repair.conversation_figures(repair.signed(named)))
    got = {}
    for r in repair.repaired_rows(named, audited).orderBy("conv", "position").collect():
        got.setdefault(r.conv, []).append((r.position, r.role, r.text))
    assert got["2"] == [(0, "user", rows[2][3]), (1, "assistant", "Yes.")]
    assert [r[1] for r in got.get("1", [])] in (["user", "assistant"], ["user", "assistant", "user", "assistant"], [])


def test_empty_and_all_dropped(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert report(empty) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    only = report(spark.createDataFrame([(gone, 0, "user", "Hi.", "", 0)], SCHEMA))
    assert only == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
