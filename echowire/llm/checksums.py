"""CRC-32C of many records at once, and its masked form.

The register is linear over GF(2), so the checksum of a record is the exclusive or of what each of its bytes
contributes. Records are cut into blocks from their end; all bytes of a block are looked up by their distance from
the block's end, and blocks are joined by advancing the register of those before.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# The reversed Castagnoli polynomial, and the constant that the record format adds to a checksum.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

#: Words of four bytes in a block, and blocks worked on at once.
BLOCK_WORDS = 64
_BLOCKS = 4096


def _one_byte() -> np.ndarray:
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(POLYNOMIAL), values >> 1).astype(np.uint32)
    return values


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """What each byte value contributes at each place of a block, and the register advanced by a block, by its bytes."""
    one, width = _one_byte(), 4 * BLOCK_WORDS
    places = np.empty((width, 256), dtype=np.uint32)
    places[-1] = one
    for place in range(width - 2, -1, -1):
        after = places[place + 1]
        places[place] = one[after & 255] ^ (after >> 8)
    advanced = np.empty((4, 256), dtype=np.uint32)
    for k in range(4):
        register = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(width):
            register = one[register & 255] ^ (register >> 8)
        advanced[k] = register
    return places, advanced


def _blocks(words: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Contributions of the blocks whose words start at `at`, of records that start at `first`."""
    places = _tables()[0].ravel()
    offsets = np.arange(4 * BLOCK_WORDS, dtype=np.int32) * 256
    out = np.empty(len(at), dtype=np.uint32)
    for low in range(0, len(at), _BLOCKS):
        index = at[low : low + _BLOCKS, None] + np.arange(BLOCK_WORDS)
        start = first[low : low + _BLOCKS, None]
        held = np.where(index < start, np.uint32(0), words[np.maximum(index, 0)])
        held = np.where(index == start, ~held, held)  # the register starts with all bits set
        data = np.ascontiguousarray(held, dtype="<u4").view(np.uint8)
        out[low : low + _BLOCKS] = np.bitwise_xor.reduce(places[offsets + data], axis=1)
    return out


def crc32c(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32C of words[start:end] (little-endian, at least one word) for each start and end."""
    advanced = _tables()[1]
    counts = -((starts - ends) // BLOCK_WORDS)
    owner = np.repeat(np.arange(len(starts)), counts)
    before = np.cumsum(counts) - counts
    number = np.arange(len(owner)) - before[owner]
    parts = _blocks(words, starts[owner], ends[owner] - (counts[owner] - number) * BLOCK_WORDS)
    register = np.zeros(len(starts), dtype=np.uint32)
    left = np.arange(len(starts))
    for k in range(int(counts.max(initial=0))):
        left = left[counts[left] > k]
        r = register[left]
        moved = advanced[0][r & 255] ^ advanced[1][(r >> 8) & 255] ^ advanced[2][(r >> 16) & 255] ^ advanced[3][r >> 24]
        register[left] = moved ^ parts[before[left] + k]
    return ~register


def masked(checksums: np.ndarray) -> np.ndarray:
    """Checksums rotated and shifted by a constant, so that a record of checksums does not check itself."""
    return ((checksums >> 15) | (checksums << 17)) + np.uint32(MASK_DELTA)
