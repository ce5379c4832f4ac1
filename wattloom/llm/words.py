"""Words of whole texts as 64-bit hashes, rolling hashes, and packed hash arrays."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import zstandard

# Bytes that are hashed at a time, rounded up to the end of a word.
BYTES_AT_ONCE = 1 << 19
# Words whose runs are hashed at a time.
WORDS_AT_ONCE = 120_000

_SPACES = b"\t\n\x0b\x0c\r "
_IS_SPACE = np.isin(np.arange(256), np.frombuffer(_SPACES, np.uint8))
_NEXT_SPACE = re.compile(rb"[\t-\r ]")
_BYTE_BASE = 0x369DEA0F31A53F85


def split_words(text: bytes | None) -> list[bytes]:
    """Runs of characters other than blank, tab, line feed, VT, FF and CR, in UTF-8."""
    return text.split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


# A random-looking number for each byte.
_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


@lru_cache(maxsize=16)
def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _hash_block(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_IS_SPACE[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    room = 1 << max(19, (len(raw) + 1).bit_length())
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[raw] * _powers(pow(_BYTE_BASE, -1, 1 << 64), room)[: len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _powers(_BYTE_BASE, room)[starts]
    return mixed(hashes + (ends - starts).astype(np.uint64)), starts


def hash_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of a UTF-8 text, and where the word starts.

    Words are runs of bytes other than blank, tab, line feed, VT, FF and CR; the hash is a
    polynomial over a word's bytes.
    """
    blocks, start = [], 0
    while len(text) - start > BYTES_AT_ONCE:
        space = _NEXT_SPACE.search(text, start + BYTES_AT_ONCE)
        if space is None:
            break
        hashes, starts = _hash_block(text[start : space.end()])
        blocks.append((hashes, starts + start))
        start = space.end()
    hashes, starts = _hash_block(text[start:] if start else text)
    blocks.append((hashes, starts + start))
    return np.concatenate([h for h, _ in blocks]), np.concatenate([s for _, s in blocks])


def hash_texts(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts as one run, and the number of words of each."""
    hashes, starts = hash_words(b" ".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def rolling_hashes(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of every run of ``length`` words: a polynomial in ``base``, an odd number.

    Words are taken a block at a time, so the tables of powers stay small.
    """
    n = max(0, len(words) - length + 1)
    found = np.empty(n, np.uint64)
    for start in range(0, n, WORDS_AT_ONCE):
        own = words[start : start + WORDS_AT_ONCE + length - 1]
        room = 1 << max(17, len(own).bit_length())
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(own * _powers(pow(base, -1, 1 << 64), room)[: len(own)], out=sums[1:])
        count = len(own) - length + 1
        sums = (sums[length:] - sums[:-length]) * _powers(base, room)[:count]
        found[start : start + count] = mixed(sums)
    return found


def pack_ascending(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers as compressed differences."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=values.dtype.type(0))
    planes = steps.view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_ascending(data: bytes, kind: np.dtype) -> np.ndarray:
    """What :func:`pack_ascending` packed."""
    kind = np.dtype(kind)
    if not data:
        return np.zeros(0, kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind)
    return np.cumsum(steps.ravel(), dtype=kind)


def is_among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which ``values`` are in ``ascending``."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return ascending[at] == values
