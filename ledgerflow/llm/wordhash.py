"""Words of a batch of UTF-8 texts as numpy arrays: where they lie and 64-bit hashes of their bytes.

A word of up to 32 bytes is hashed from its four 8-byte parts and its length, a longer one by BLAKE2b
over all of it; so no two places of a long word share a multiplier.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SHORT = 32

_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer: each bit of the result depends on each of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def whole_hash(word: bytes) -> np.uint64:
    """Hash over all bytes of a word, for those that are longer than a table of multipliers."""
    return np.uint64(int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little"))


def seed(value: str) -> np.uint64:
    """A fixed 64-bit number for a string."""
    return whole_hash(value.encode())


@dataclass
class Words:
    data: np.ndarray      # bytes of all texts
    start: np.ndarray     # of each word in data
    end: np.ndarray
    row: np.ndarray       # text of each word
    first: np.ndarray     # first word of each text, and the number of words at the end
    hash: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, one text after another, and where each begins (and the last ends); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    bounds = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8)[bounds[0]:bounds[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each word data[start:end]."""
    n = end - start
    padded = np.concatenate([data, np.zeros(SHORT + 8, np.uint8)])
    eights = np.ndarray((len(data) + SHORT,), np.dtype("<u8"), padded, 0, (1,))  # the 8 bytes from each place on
    out = n.astype(np.uint64) * _K[3]
    for part in range(0, SHORT, 8):
        who = np.flatnonzero(n > part)
        if not len(who):
            break
        left = np.minimum(n[who] - part, 8).astype(np.uint64)
        value = eights[start[who] + part] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        out[who] = mixed(out[who] + value * _K[part // 8 % 3] + _K[(part // 8 + 1) % 4])
    for i in np.flatnonzero(n > SHORT).tolist():
        out[i] = whole_hash(data[start[i]:end[i]].tobytes())
    return out


def cut(data: np.ndarray, bounds: np.ndarray, outside: np.ndarray) -> Words:
    """Words are runs of bytes that aren't ``outside`` (a table of 256); none reaches into another text."""
    inside = np.concatenate([~outside[data], [False]])
    edge = np.zeros(len(data) + 1, bool)          # places where a new text begins
    edge[bounds] = True
    before = np.concatenate([[False], inside[:-1]])
    start = np.flatnonzero(inside & (~before | edge))
    end = np.flatnonzero(before & (~inside | edge))
    first = np.searchsorted(start, bounds)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    return Words(data, start, end, row, first, hashes(data, start, end))


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


WHITE = byte_table(b" \t\n\v\f\r")
