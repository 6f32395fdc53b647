"""Compressed bitmaps over 65,536 places, in batches.

A bitmap is a binary value: ascending little-endian 16-bit places, or, from
``DENSE`` places on, the 8,192 bytes of the plain bit set. Which of the two
follows from the length. All functions take and give whole Arrow columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PLACES = 1 << 16
DENSE = PLACES // 16
_BYTES = PLACES // 8


def pack(sizes: np.ndarray, places: np.ndarray) -> pa.Array:
    """One bitmap for each of ``sizes`` runs of distinct ascending ``places``."""
    places = places.astype("<u2")
    dense = sizes >= DENSE
    if not dense.any():
        return _binary(np.cumsum(np.r_[0, sizes]) * 2, places)
    words = np.where(dense, _BYTES // 2, sizes)
    ends, starts = np.cumsum(words), np.cumsum(sizes) - sizes
    out = np.zeros(int(ends[-1]), "<u2")
    thin = np.repeat(~dense, sizes)
    out[(np.repeat(ends - words - starts, sizes) + np.arange(len(places)))[thin]] = places[thin]
    for i in np.flatnonzero(dense):
        bits = np.zeros(PLACES, np.uint8)
        bits[places[starts[i]:starts[i] + sizes[i]]] = 1
        out[ends[i] - words[i]:ends[i]] = np.packbits(bits, bitorder="little").view("<u2")
    return _binary(np.r_[0, ends] * 2, out)


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary column without nulls."""
    if not len(column):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places of all bitmaps, each with the index of its bitmap."""
    offsets, data = _buffers(column)
    lengths = np.diff(offsets)
    dense = lengths == _BYTES
    if not dense.any():
        return np.repeat(np.arange(len(column)), lengths // 2), data[offsets[0]:offsets[-1]].view("<u2")
    sets = [np.flatnonzero(np.unpackbits(data[offsets[i]:offsets[i + 1]], bitorder="little")) for i in np.flatnonzero(dense)]
    thin = np.repeat(~dense, lengths)
    which = [np.repeat(np.arange(len(column))[~dense], lengths[~dense] // 2)]
    which += [np.full(len(s), i) for s, i in zip(sets, np.flatnonzero(dense))]
    places = [np.ascontiguousarray(data[offsets[0]:offsets[-1]][thin]).view("<u2"), *sets]
    return np.concatenate(which), np.concatenate([p.astype(np.int64) for p in places])


def popcounts(column: pa.Array) -> np.ndarray:
    """How many places each bitmap has."""
    offsets, data = _buffers(column)
    sizes = np.diff(offsets) // 2
    for i in np.flatnonzero(sizes == _BYTES // 2):
        sizes[i] = int(np.bitwise_count(data[offsets[i]:offsets[i + 1]].view("<u8")).sum())
    return sizes


def union(column: pa.Array, group: np.ndarray, groups: int) -> pa.Array:
    """The bitmaps OR-ed together by ``group``, one for each of ``groups``."""
    which, places = unpack(column)
    merged = np.unique((group[which].astype(np.int64) << 16) | places.astype(np.int64))
    return pack(np.bincount(merged >> 16, minlength=groups), merged & (PLACES - 1))
