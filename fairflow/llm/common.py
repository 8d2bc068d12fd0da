"""Shared helpers: text as flat byte arrays, vectorised words and hashes, packed columns.

Everything here works on one Arrow batch inside a task.  Texts are cut into blocks of
whole documents, so memory follows the block size and the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def byte_values(seed: int) -> np.ndarray:
    """One 64-bit value per byte."""
    return mix((np.arange(1, 257, dtype=np.uint64) + np.uint64(seed << 16)) * np.uint64(BASE))


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per worker."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size > 1 << 23:
            return have[:n]
        _POWERS[base] = have
    return have[:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes: entry i is the sum of values[j] * BASE**j over j < i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the half-open ranges, independent of where they stand."""
    inverse = powers(len(prefix), BASE_INVERSE)
    return (prefix[ends] - prefix[starts]) * inverse[starts]


def text_blocks(column: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with ``limit`` bytes at most;
    a longer text is a block of its own.  NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n, buffers = len(column), column.buffers()
    if not n:
        return
    offsets = np.frombuffer(buffers[1], np.int64 if large else np.int32)[column.offset:column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


SPACES = np.ones(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and ``first``: the words of row r are first[r]:first[r+1].
    ``inside`` says which bytes belong to a word.  Words never cross rows."""
    n = len(data)
    mask = inside[data]
    edge = np.empty(n + 1, bool)
    if n:
        edge[0], edge[n] = mask[0], False
        edge[1:n] = mask[1:] & ~mask[:-1]
        cuts = offsets[:-1][offsets[:-1] < n]
        edge[cuts] = mask[cuts]
    starts = np.flatnonzero(edge[:n])
    if n:
        edge[0] = False
        edge[1:n] = mask[:-1] & ~mask[1:]
        edge[n] = mask[-1]
        cuts = offsets[1:][offsets[1:] > 0]
        edge[cuts] = mask[cuts - 1]
    ends = np.flatnonzero(edge)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    prefix = prefix_hashes(byte_values(seed)[data])
    return mix(range_hashes(prefix, starts, ends) ^ (ends - starts).astype(np.uint64))


def window_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hash of every ``length`` consecutive tokens (rows are not regarded)."""
    if len(tokens) < length:
        return np.empty(0, np.uint64)
    prefix = prefix_hashes(tokens)
    at = np.arange(len(tokens) - length + 1)
    return mix(range_hashes(prefix, at, at + length))


def windows_inside(first: np.ndarray, length: int) -> np.ndarray:
    """Starts of the windows of ``length`` items that stay within a row, in order."""
    total, rows = int(first[-1]), np.diff(first)
    keep = np.ones(total, bool)
    for back in range(1, length):
        at = first[1:] - back
        keep[at[(at >= first[:-1]) & (rows > 0)]] = False
    return np.flatnonzero(keep)


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` positions some range [start, start + length) covers."""
    steps = np.bincount(starts, minlength=size + 1) - np.bincount(starts + length, minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edges = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs; the first byte is that width."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers as packed differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)
