"""Words of many texts at once: a class array over bytes tells words apart, without an expression or a loop over words.

Words are maximal stretches of a-z, 0-9 and whatever is not ASCII, A-Z in lower case. All bytes of a character outside of
ASCII are 0x80 or more, so bytes will do for UTF-8.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLANK = 32
#: A byte of a word as it is in lower case; every other byte a blank.
_CLASS = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else BLANK for b in range(256)], np.uint8)
#: Powers of an odd number modulo 2^64, from the place of a byte within its word.
_POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64))
#: Longer words get their checksum one by one.
LONG = 48


@dataclass
class Words:
    """buf: the words of all texts, each with a blank behind it; word k is buf[start[k]:end[k]] and of text row[k]; counts:
    words of each text; first: each text's first word."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    counts: np.ndarray
    first: np.ndarray


def words_of(texts: pa.Array) -> Words:
    """The words of ``texts``, an array of strings without nulls that each end in a byte that is of no word, such as \\n."""
    rows = len(texts)
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, wide)[texts.offset : texts.offset + rows + 1].astype(np.int64) if rows else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
    mapped = _CLASS[data]
    inside = np.zeros(len(data) + 1, bool)
    np.not_equal(mapped, BLANK, out=inside[1:])
    begins = inside[1:] > inside[:-1]
    keep = inside[1:] | (inside[1:] < inside[:-1])  # with the blank behind each word
    first_byte = np.flatnonzero(begins)
    buf = mapped[keep]
    end = np.flatnonzero(buf == BLANK)
    start = np.r_[0, end[:-1] + 1][: len(end)]
    row = np.searchsorted(bounds[1:] - bounds[0], first_byte, side="right")
    counts = np.bincount(row, minlength=rows)
    return Words(buf, start, end, row, counts, np.cumsum(counts) - counts)


def hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word. Unequal words may share one, equal words always do."""
    if not len(w.start):
        return np.empty(0, np.uint64)
    lengths = w.end - w.start + 1
    place = np.arange(len(w.buf)).astype(np.uint8) - np.repeat(w.start.astype(np.uint8), lengths)  # modulo 256
    return np.add.reduceat((w.buf + np.uint64(1)) * _POWERS[place], w.start)


def shingle_hashes(w: Words, own: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first words, hashes) of all runs of ``size`` words within a text, from the words' hashes."""
    n = len(own) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    mixed = np.full(n, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ own[k : k + n]) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
    at = np.flatnonzero(w.row[:n] == w.row[size - 1 :])
    return at, mixed[at]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def checksums(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The CRC-32 of each slice of ``buf``, byte by byte over all slices at once."""
    out = np.full(len(start), 0xFFFFFFFF, np.uint32)
    lengths = end - start
    long = np.flatnonzero(lengths > LONG)
    open_ = np.flatnonzero((lengths > 0) & (lengths <= LONG))
    crc, at, rest = out[open_], start[open_], lengths[open_]
    k = 0
    while len(open_):
        crc = _CRC[(crc ^ buf[at + k]) & 0xFF] ^ (crc >> np.uint32(8))
        k += 1
        ended = rest == k
        out[open_[ended]] = crc[ended]
        on = ~ended
        open_, crc, at, rest = open_[on], crc[on], at[on], rest[on]
    out ^= np.uint32(0xFFFFFFFF)
    for i in long.tolist():
        out[i] = zlib.crc32(buf[start[i] : end[i]].tobytes())
    return out
