"""Plain counterparts of the corpus operators, row by row, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Union:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingle_sets(rows, width=5):
    out = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out[doc] = frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()
    return out


def near_duplicates(rows, percent=75):
    """doc_id -> (n_shingles, component_id, kept)."""
    sets = shingle_sets(rows)
    union, holders = Union(sets), defaultdict(list)
    for doc, held in sets.items():
        common = defaultdict(int)
        for s in held:
            for other in holders[s]:
                common[other] += 1
            holders[s].append(doc)
        for other, n in common.items():
            if 100 * n >= percent * (len(held) + len(sets[other]) - n):
                union.join(doc, other)
    return {d: (len(s), union.find(d), union.find(d) == d) for d, s in sets.items()}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    """Lists of base spans by kind."""
    out = {}
    for kind, pattern in PII.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 9 <= len(digits) <= 15
            ):
                out[kind].append((m.start(), m.end()))
    return out


def pii_hash(found):
    listed = ",".join(f"{k}:{s}:{e}" for k in PII for s, e in found[k])
    return hashlib.sha256(listed.encode()).hexdigest()


def kept_lines(rows, min_docs=10):
    """doc_id -> (n_lines, n_dropped, kept text)."""
    blank = " \t\n\x0b\x0c\r"
    docs = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            docs[line.strip(blank).translate(LOWER)].add(doc)
    gone = {k for k, d in docs.items() if k and len(d) >= min_docs}
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if x.strip(blank).translate(LOWER) not in gone]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def licence_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def phrase_starts(words, phrase):
    parts = phrase.split()
    return [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]


def edit_distance_to_passage(item, text):
    """Smallest edit distance of the item to any passage of the text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, a in enumerate(item):
            new.append(min(row[i] + (a != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best
