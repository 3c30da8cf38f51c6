"""Token ids of texts that are lists of pieces, each distinct piece encoded once as long as a worker remembers it."""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa


class Generation:
    """Pieces by number, with the ids of all of them one after another."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 14, np.uint32), 0
        self.begins, self.sizes = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.bytes = 0

    def add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, used = len(self.known), self.used
        for name, need in (("ids", used + len(ids)), ("begins", n + len(pieces)), ("sizes", n + len(pieces))):
            if need > len(old := getattr(self, name)):
                setattr(self, name, np.concatenate([old, np.zeros(max(len(old) // 2, need - len(old)), old.dtype)]))
        self.ids[used : used + len(ids)] = ids
        self.sizes[n : n + len(pieces)] = sizes
        self.begins[n : n + len(pieces)] = used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.known.update(zip(pieces, range(n, n + len(pieces)), strict=True))
        # what a string, its entry and its ids take
        self.bytes += 170 * len(pieces) + sum(map(len, pieces)) + 4 * len(ids)

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces by number, and how many each has."""
        n = self.sizes[places]
        ends = np.cumsum(n)
        return self.ids[np.repeat(self.begins[places] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], n


class PieceCache:
    """learn: from pieces not met before to all their ids and how many each has.

    Two generations hold what was met: a piece of the old one that is met again moves to the new one. When the new one
    has `most` bytes it becomes the old one, and what that one held is forgotten, so memory is bounded by about twice
    that besides the pieces of one batch.
    """

    def __init__(self, learn: Callable[[list], tuple[np.ndarray, np.ndarray]], most: int):
        self.learn, self.most = learn, most
        self.new, self.old = Generation(), Generation()

    def encode(self, texts: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's begin, with the end of the last."""
        offsets = texts.offsets.to_numpy()
        coded = texts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if self.new.bytes >= self.most:
            self.old, self.new = self.new, Generation()
        number = np.fromiter(map(self.new.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        if len(missing := np.flatnonzero(number < 0)):
            pieces = [distinct[i] for i in missing.tolist()]
            old = np.fromiter(map(self.old.known.get, pieces, repeat(-1)), np.int64, len(pieces))
            for at, of in ((np.flatnonzero(old >= 0), lambda x: self.old.of(old[old >= 0])), (np.flatnonzero(old < 0), self.learn)):
                if len(at):
                    some = [pieces[i] for i in at.tolist()]
                    number[missing[at]] = len(self.new.known) + np.arange(len(at))
                    self.new.add(some, *of(some))
        place = number[coded.indices.to_numpy()]
        ids, n = self.new.of(place)
        return ids, np.concatenate([[0], np.cumsum(n)])[offsets - offsets[0]]
