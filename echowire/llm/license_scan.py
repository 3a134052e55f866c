"""Licence scans: an Aho-Corasick automaton over whole texts, and a shunting-yard parser for licence expressions.

A text is lower-cased (A-Z) and taken as words; all phrases are found in one pass as runs of whole words. Where a
text holds the identifier tag, the expression behind it is parsed with the precedence of with, and, or, and
evaluated against a set of accepted licences. Identifiers are looked up in a list of public ones, so the first word of
prose behind a tag counts as unknown and weighs little, as do phrases that prose uses too.

Cases: a null or empty text has no words, no labels and score 0. Every place counts, overlapping ones too. Repeated
rows give repeated results. Rows are independent, so nothing is shuffled and memory is bounded by one slice of rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from echowire.llm.frames import map_rows, texts, utf8

# The base phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Further notices, as words, with their labels.
NOTICES = {
    "apache license": "apache",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "boost software license": "bsl",
    "isc license": "isc",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "free documentation license": "gfdl",
}

#: Phrases that prose uses as well; they speak less for a statement.
MENTIONS = {
    "creative commons": "cc",
    "public domain": "public-domain",
}

TAG = "spdx license identifier"

# Public licence identifiers and exceptions, in lower case.
KNOWN = frozenset(
    "0bsd afl-2.1 afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0 artistic-1.0 artistic-2.0 "
    "blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1 "
    "cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 "
    "cc-by-sa-2.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cpl-1.0 curl ecl-2.0 epl-1.0 epl-2.0 "
    "eupl-1.1 eupl-1.2 ftl gfdl-1.2 gfdl-1.3 gfdl-1.3-only gfdl-1.3-or-later gpl-1.0 gpl-2.0 gpl-2.0-only gpl-2.0-or-later "
    "gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd icu isc lgpl-2.0 lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 "
    "lgpl-3.0-only lgpl-3.0-or-later libpng-2.0 lppl-1.3c mit mit-0 mpl-1.1 mpl-2.0 mpl-2.0-no-copyleft-exception ms-pl ms-rl "
    "mulanpsl-2.0 ncsa odbl-1.0 ofl-1.1 openssl osl-3.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sissl sleepycat "
    "unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1".split()
)
EXCEPTIONS = frozenset(
    "autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception classpath-exception-2.0 "
    "font-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 libtool-exception linux-syscall-note llvm-exception "
    "openvpn-openssl-exception qt-gpl-exception-1.0 swift-exception u-boot-exception-2.0 universal-foss-exception-1.0 "
    "wxwindows-exception-3.1".split()
)
#: What identifiers that an expression defines by itself start with.
OWN = ("licenseref-", "documentref-")

#: Licences that an expression is evaluated against, in lower case.
ACCEPTED = frozenset(
    ["apache-2.0", "mit", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "bsl-1.0", "cc0-1.0", "cc-by-4.0", "unlicense"]
)

#: How far a label of each kind speaks for a licence statement; the score of a text joins them as 1 - product of (1 - weight).
WEIGHTS = {"tag": 0.95, "notice": 0.8, "base": 0.6, "mention": 0.3, "unknown": 0.2}

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_EXPRESSION = re.compile(r"spdx-license-identifier[ \t]*:?[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard: the postfix form of the expression that `expression` starts with, lower-cased.

    Reading stops at the first token that cannot follow (prose behind the expression). None if there is no
    operand or a bracket or operator is left open.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next, at = True, 0
    while match := _TOKEN.match(expression, at):
        token = match[1].lower()
        if token == "(":
            if not operand_next:
                break
            stack.append(token)
        elif token == ")":
            if operand_next or "(" not in stack:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif token in _PRECEDENCE:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        else:
            if not operand_next:
                break
            out.append(token)
            operand_next = False
        at = match.end()
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(postfix: list[str], accepted: frozenset[str] = ACCEPTED) -> bool:
    """Whether the accepted licences satisfy the expression. An exception (with) only adds rights to its licence."""
    stack: list[bool] = []
    for token in postfix:
        if token not in _PRECEDENCE:
            stack.append(token in accepted)
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(left if token == "with" else left and right if token == "and" else left or right)
    return stack[0]


def labels_of(postfix: list[str], known: frozenset[str] = KNOWN, exceptions: frozenset[str] = EXCEPTIONS) -> dict[str, str]:
    """Labels and their kinds: known licences by name; the first word of prose behind a tag is no licence, but `spdx:unknown`."""
    labels = {}
    for i, token in enumerate(postfix):
        if token in _PRECEDENCE:
            continue
        exception = postfix[i + 1 : i + 2] == ["with"]
        if token in exceptions if exception else token.removesuffix("+") in known or token.startswith(OWN):
            labels |= {} if exception else {f"spdx:{token}": "tag"}
        else:
            labels["spdx:unknown"] = "unknown"
    return labels


class Scanner:
    """Finds phrases as runs of whole words in one pass."""

    def __init__(self, base: Mapping[str, str], notices: Mapping[str, str], mentions: Mapping[str, str], accepted: frozenset[str]):
        self.accepted = accepted
        self.automaton = ahocorasick.Automaton()
        entries: dict[str, list[tuple[str, str]]] = {}
        for kind, phrases in (("base", base), ("notice", notices), ("mention", mentions), ("tag", {TAG: ""})):
            for phrase, label in phrases.items():
                entries.setdefault(phrase, []).append((kind, label))
        for phrase, found in entries.items():
            # bytes as characters, so that positions and words are those of the UTF-8 text
            key = f" {phrase} ".encode().decode("latin-1")
            self.automaton.add_word(key, (len(key), found))
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple:
        words = text.translate(_WORD_BYTES).split()
        if not words:
            return 0, 0, None, None, "", "", 0.0, [], None
        line = f" {b' '.join(words).decode('latin-1')} "
        first = last = None
        places = counted = word = 0
        labels: dict[str, str] = {}  # label: strongest kind
        base_labels = set()
        tagged = False
        hits = sorted((end - size + 1, found) for end, (size, found) in self.automaton.iter(line))
        for start, found in hits:
            word += line.count(" ", counted, start)
            counted = start
            for kind, label in found:
                if kind == "tag":
                    tagged = True
                    continue
                if kind == "base":
                    places += 1
                    first = word if first is None else first
                    last = word
                    base_labels.add(label)
                if WEIGHTS[kind] > WEIGHTS.get(labels.get(label, ""), 0):
                    labels[label] = kind
        expressions, fits = [], None
        if tagged:
            for match in _EXPRESSION.finditer(text.decode("utf-8", "replace")):
                postfix = to_postfix(match[1])
                if postfix:
                    expressions.append(" ".join(postfix))
                    fits = (fits is not False) and evaluate(postfix, self.accepted)
                    labels |= labels_of(postfix)
                else:
                    labels["spdx:invalid"] = "unknown"
        doubt = 1.0
        for label in labels:
            doubt *= 1 - WEIGHTS[labels[label]]
        score = round(1 - doubt, 6)
        return (len(words), places, first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score,
                expressions, fits)


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, expressions array<string>, accepted boolean"
)


def license_scan(
    docs: DataFrame,
    base: Mapping[str, str] = BASE,
    notices: Mapping[str, str] = NOTICES,
    mentions: Mapping[str, str] = MENTIONS,
    accepted: frozenset[str] = ACCEPTED,
) -> DataFrame:
    """One row per document: counts and places of the base phrases, all labels, and the licence expressions.

    `expressions` holds the postfix forms found behind identifier tags and `accepted` says whether the accepted
    licences satisfy all of them (null without a valid one). Phrases are given as lower-case words.
    """

    def make():
        scanner = Scanner(base, notices, mentions, accepted)

        def scan(batch: pa.RecordBatch) -> list:
            found = [scanner.scan(t) for t in utf8(batch, "text")]
            return [batch.column("doc_id"), *(list(c) for c in zip(*found))]

        return scan

    return map_rows(texts(docs), SCHEMA, make)


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    from echowire.llm.frames import table

    return license_scan(table(spark, sf_dir, "documents"))
