"""Word and shingle hashes of whole texts, vectorised over bytes.

Words are runs of bytes other than ASCII white space, A-Z lower-cased. The hash of a word is a polynomial over its
bytes modulo 2**64, taken from prefix sums and finished by a mixer; it does not depend on where the word stands.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Bytes of a text that are worked on at once.
CHUNK = 1 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 1 << 14

_BLANK = b" \t\n\x0b\x0c\r"
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_IS_BLANK = np.array([b in _BLANK for b in range(256)])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_VALUES = np.array([xxhash.xxh64_intdigest(bytes([b]), seed=7) for b in range(256)], dtype=np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_POWERS: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        _POWERS["up"], _POWERS["down"] = _powers(_BASE, CHUNK), _powers(_INVERSE, CHUNK)
    return _POWERS["up"], _POWERS["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chunk_hashes(text: bytes) -> np.ndarray:
    up, down = _tables()
    data = np.frombuffer(text, np.uint8)
    blank = np.ones(len(data) + 2, dtype=bool)
    blank[1:-1] = _IS_BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _STEP)


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text in order."""
    text = text.translate(LOWER)
    if len(text) <= LONG_WORD:
        return _chunk_hashes(text)
    parts, at = [], 0
    while at < len(text):
        end = min(len(text), at + CHUNK - LONG_WORD)
        while end < len(text) and text[end] not in _BLANK and end - at < CHUNK:
            end += 1
        piece = text[at:end]
        if max(map(len, piece.split()), default=0) <= LONG_WORD and (end == len(text) or text[end] in _BLANK):
            parts.append(_chunk_hashes(piece))
            at = end
            continue
        words = [m for m in _words(text, at, end)]
        parts += [_word_hash(text[s:e]) for s, e in words]
        at = max(end, words[-1][1])
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _words(text: bytes, at: int, end: int):
    """Places of the words that start in [at, end)."""
    while at < end:
        if text[at] in _BLANK:
            at += 1
            continue
        stop = min((p for p in (text.find(bytes([b]), at) for b in _BLANK) if p >= 0), default=len(text))
        yield at, stop
        at = stop


def _word_hash(word: bytes) -> np.ndarray:
    if len(word) <= LONG_WORD:
        return _chunk_hashes(word)
    return np.array([xxhash.xxh64_intdigest(word, seed=11)], dtype=np.uint64)


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `width` words; of the whole sequence if it is shorter; empty without words."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        total = total * _BASE + words[i : i + n]
    return np.unique(mixed(total))
