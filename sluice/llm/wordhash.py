"""Vectorised 64-bit hashes of words and of runs of words, over Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 2_000_000
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


#: One number per byte, A-Z folded to a-z; and the multiplier of the rolling sum.
BYTES = mix(np.arange(1, 257, dtype=_U))
BYTES[65:91] = BYTES[97:123]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        one = np.full(size, _U(_BASE))
        one[0] = 1
        two = np.full(size, _U(_INVERSE))
        two[0] = 1
        _powers[:] = [np.cumprod(one, dtype=_U), np.cumprod(two, dtype=_U)]
    return _powers[0], _powers[1]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), offsets


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes together; a longer row is alone."""
    i = 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each text, and how many words each text has.

    Words end at ASCII white space and at a text's end."""
    if len(data) > 4 * CHUNK:  # one long text: in pieces that end at white space
        parts, at = [], 0
        while at < len(data):
            end = min(len(data), at + CHUNK)
            while end < len(data) and not SPACE[data[end - 1]]:
                end += 1
            parts.append(word_hashes(data[at:end], np.array([0, end - at]))[0])
            at = end
        found = np.concatenate(parts)
        return found, np.array([len(found)])
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(last) + 1
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(BYTES[data] * power[:len(data)], out=sums[1:])
    found = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U))
    return found, np.diff(np.searchsorted(starts, offsets))


_STEPS = mix(np.arange(301, 401, dtype=_U)) | _U(1)


def shingles(found: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within a text, and how many each text
    has. A text of fewer words, but not none, is one run."""
    ends = np.cumsum(counts)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    total = len(found)
    if not total:
        return found, n
    runs = np.zeros(max(0, total - size + 1), _U)
    for k in range(size):
        runs += found[k:total - size + 1 + k] * _STEPS[k] if len(runs) else _U(0)
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = owner[:len(runs)] == owner[size - 1:] if len(runs) else np.empty(0, bool)
    long, owners = runs[inside], owner[:len(runs)][inside]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.array([
            (found[ends[i] - counts[i]:ends[i]] * _STEPS[:counts[i]]).sum(dtype=_U) + _U(int(counts[i])) for i in short
        ], _U)
        owners = np.concatenate((owners, short))
        long = np.concatenate((long, extra))[np.argsort(owners, kind="stable")]
    return mix(long), n
