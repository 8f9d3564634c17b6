"""Words of many texts at once, and their hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
# XXH64 takes values of this length or more in stripes, those below in lanes.
_STRIPE = 32


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _hashed_short(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH64 of values under _STRIPE bytes; ``data`` goes on for 8 bytes after the last."""

    def read(kind: str, at: np.ndarray) -> np.ndarray:
        width = np.dtype(kind).itemsize
        return np.ndarray((len(data) - width + 1,), kind, data, strides=(1,))[at].astype(np.uint64)

    h = sizes.astype(np.uint64) + _P5
    for lane in range(_STRIPE // 8 - 1):
        on = np.flatnonzero(sizes >= 8 * lane + 8)
        if not len(on):
            break
        h[on] = _turned(h[on] ^ _turned(read("<u8", starts[on] + 8 * lane) * _P2, 31) * _P1, 27) * _P1 + _P4
    at = starts + (sizes & -8)
    on = np.flatnonzero(sizes & 4)
    h[on] = _turned(h[on] ^ read("<u4", at[on]) * _P1, 23) * _P2 + _P3
    at = starts + (sizes & -4)
    for byte in range(3):
        on = np.flatnonzero((sizes & 3) > byte)
        h[on] = _turned(h[on] ^ data[at[on] + byte].astype(np.uint64) * _P5, 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def hashed(values: pa.Array) -> np.ndarray:
    """XXH64 of each value of a string or binary array without NULL."""
    values = values.cast(pa.binary())
    n = len(values)
    if not n:
        return np.empty(0, np.uint64)
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int32)[values.offset : values.offset + n + 1].astype(np.int64)
    begin, end = int(offsets[0]), int(offsets[-1])
    held = np.zeros(end - begin + 8, np.uint8)
    if end > begin:
        held[:-8] = np.frombuffer(data, np.uint8)[begin:end]
    starts, sizes = offsets[:-1] - begin, np.diff(offsets)
    long = np.flatnonzero(sizes >= _STRIPE)
    out = _hashed_short(held, starts, np.where(sizes >= _STRIPE, 0, sizes))
    for i in long.tolist():
        out[i] = xxhash.xxh64_intdigest(held[starts[i] : starts[i] + sizes[i]])
    return out


def lowered(texts: pa.Array) -> pa.Array:
    """Texts with A-Z in lower case; NULL is empty."""
    return pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))


def words_at(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the words of all texts, one after the other; the number of each text): what bytes.split() gives."""
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    owner = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    counts = np.bincount(owner[real], minlength=len(texts)).astype(np.int64)
    return (words if real.all() else words.filter(pa.array(real))), counts
