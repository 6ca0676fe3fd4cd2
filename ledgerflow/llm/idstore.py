"""Token ids of text units that a worker has met, kept flat so that numpy can gather them."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

from .textbatch import ragged

UNITS_KEPT = 400_000     # units that a worker remembers; beyond, those used once are forgotten
CHARS_KEPT = 8 << 20     # characters of them, as texts without spaces are units of any length
IDS_KEPT = 8 << 20       # ids of units whose texts aren't kept

Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


class Numbering(dict):
    """Numbers of units by first appearance; ``new`` lists those that aren't encoded yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.new.append(unit)
        return number


class IdStore:
    """``encode_new`` gives new units' ids end to end, and how many each has.

    With ``counts_only`` the ids it gives are not kept.
    """

    def __init__(self, encode_new: Encode, counts_only: bool = False, kept: int = UNITS_KEPT):
        self.encode_new, self.counts_only, self.kept = encode_new, counts_only, kept
        self.known = Numbering()
        self.chars = 0
        self.flat = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the units that were used more than once; none where those are too many as well."""
        keep = np.flatnonzero(self.uses > 1)
        units = list(self.known)
        self.chars = sum(len(units[i]) for i in keep.tolist())
        if len(keep) > 0.8 * self.kept or self.chars > 0.8 * CHARS_KEPT:
            keep, self.chars = keep[:0], 0
        self.known = Numbering()
        self.known.update((units[i], n) for n, i in enumerate(keep.tolist()))
        sizes = self.size[keep]
        if not self.counts_only:
            self.flat = self.flat[ragged(self.start[keep], sizes)]
        self.start, self.size, self.uses = np.cumsum(sizes) - sizes, sizes, np.zeros(len(keep), np.int64)

    def _numbers(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.kept or self.chars > CHARS_KEPT:
            self._forget()
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        unit = np.fromiter(map(self.known.__getitem__, chain.from_iterable(texts)), np.int64, int(counts.sum()))
        if self.known.new:
            ids, size = self.encode_new(self.known.new)
            self.chars += sum(map(len, self.known.new))
            self.known.new = []
            self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(size) - size))
            self.size = np.concatenate((self.size, size))
            self.uses = np.concatenate((self.uses, np.zeros(len(size), np.int64)))
            if not self.counts_only:
                self.flat = np.concatenate((self.flat, ids.astype(np.int32)))
        self.uses += np.bincount(unit, minlength=len(self.uses))
        return unit, counts

    def ids_of(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as units, end to end, and how many each text has."""
        unit, counts = self._numbers(texts)
        sizes = self.size[unit]
        return self.flat[ragged(self.start[unit], sizes)], _sums(sizes, counts)

    def counts_of(self, texts: list[list[str]]) -> np.ndarray:
        """How many ids each of the texts has."""
        unit, counts = self._numbers(texts)
        return _sums(self.size[unit], counts)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return np.diff(total[np.concatenate(([0], np.cumsum(counts)))])


class HashedStore:
    """As IdStore, for units that are given as 64-bit hashes; their texts are only made where they are new.

    Two units of one hash would be taken for one: with n distinct units that happens with a probability
    of n * n / 2 ** 65 (under 1e-5 for ten million).
    """

    def __init__(self, encode_new: Encode, kept: int = UNITS_KEPT):
        self.encode_new, self.kept = encode_new, kept
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.flat = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _forget(self) -> None:
        keep = np.flatnonzero(self.uses > 1)
        keep = keep[:0] if len(keep) > 0.8 * self.kept or self.size[keep].sum() > 0.8 * IDS_KEPT else keep
        self.flat = self.flat[ragged(self.start[keep], self.size[keep])]
        self.hashes, self.size = self.hashes[keep], self.size[keep]
        self.start, self.uses = np.cumsum(self.size) - self.size, np.zeros(len(keep), np.int64)

    def ids_of(self, hashes: np.ndarray, texts: Callable[[np.ndarray], list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units end to end, and how many each has; ``texts`` gives the units at some places."""
        if len(self.hashes) > self.kept or len(self.flat) > IDS_KEPT:
            self._forget()
        distinct, first, back, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.hashes, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != distinct[inside]
        if new.any():
            ids, size = self.encode_new(texts(first[new]))
            start = len(self.flat) + np.cumsum(size) - size
            self.flat = np.concatenate((self.flat, ids.astype(np.int32)))
            where = at[new]
            self.start, self.size = np.insert(self.start, where, start), np.insert(self.size, where, size)
            self.uses = np.insert(self.uses, where, 0)
            self.hashes = np.insert(self.hashes, where, distinct[new])
            at = np.searchsorted(self.hashes, distinct)
        self.uses[at] += count
        unit = at[back]
        return self.flat[ragged(self.start[unit], self.size[unit])], self.size[unit]
