"""Texts as numbers of distinct words, and a compact memory of what words encode to."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have inverses modulo 2^64


def split_at(texts: list[str], mark: str):
    """(distinct words, number of each word of all texts in order, place of the first word
    of each text and the end): the texts cut at every ``mark``."""
    lists = pc.split_pattern(pa.array(texts, pa.large_string()), pattern=mark)
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.asarray(lists.offsets)


def gather(starts: np.ndarray, sizes: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Places of the runs ``starts[k] .. starts[k] + sizes[k] - 1`` for each ``k`` in ``picked``, in order."""
    n = sizes[picked]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts[picked] - (ends - n), n) + np.arange(total)


class Powers:
    """Powers of a base and of its inverse, modulo 2^64."""

    def __init__(self, base: int):
        self.base = base
        self.up = self.down = np.ones(1, U)

    def grow(self, n: int):
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, self.base, U)]))
                self.down = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, pow(self.base, -1, 1 << 64), U)]))


class WordMemory:
    """For up to ``max_words`` words the rows (of ``width`` int32 numbers) that each encodes to.

    Words are known by two independent 64-bit hashes of their bytes and length; a word
    takes 24 bytes and its rows.  A full memory starts anew."""

    def __init__(self, max_words: int = 1 << 20, width: int = 1):
        self.max_words, self.width = max_words, width
        self.powers = [Powers(b) for b in BASES]
        self.clear()

    def clear(self):
        self.keys, self.seconds = np.empty(0, U), np.empty(0, U)
        self.starts, self.sizes = np.empty(0, np.int32), np.empty(0, np.int32)
        self.rows, self.used = np.empty((0, self.width), np.int32), 0

    def hashes(self, words: pa.LargeStringArray) -> list[np.ndarray]:
        n = len(words)
        ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + n + 1]
        raw = words.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[ends[0]:ends[-1]] if raw is not None and n else np.empty(0, np.uint8)
        ends = ends - ends[0]
        out, size = [], np.diff(ends).astype(U)
        letters = data.astype(U) + U(1)
        with np.errstate(over="ignore"):
            for p in self.powers:
                p.grow(len(data) + 1)
                run = np.zeros(len(data) + 1, U)
                np.cumsum(letters * p.up[:len(data)], out=run[1:])
                h = (run[ends[1:]] - run[ends[:-1]]) * p.down[ends[:-1]] + size * U(p.base)
                h ^= h >> U(31)
                h *= U(0x94D049BB133111EB)
                out.append(h ^ (h >> U(29)))
        return out

    def find(self, keys: np.ndarray, seconds: np.ndarray) -> np.ndarray:
        """Places of the words in the memory; -1 where they are not known."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        order = np.argsort(keys)  # neighbours are looked up one after the other
        at = np.empty(len(keys), np.int64)
        at[order] = np.minimum(np.searchsorted(self.keys, keys[order]), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (self.seconds[at] == seconds), at, -1)

    def add(self, keys, seconds, sizes, rows):
        """New words (different from all known ones), with their rows one after the other."""
        if len(self.keys) + len(keys) > self.max_words:
            self.clear()
            keys, seconds, sizes = (x[:self.max_words] for x in (keys, seconds, sizes))
            rows = rows[:int(sizes.sum())]
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        starts = self.used + np.cumsum(sizes) - sizes
        need = self.used + len(rows)
        if need > len(self.rows):
            grown = np.empty((max(need, len(self.rows) * 3 // 2), self.width), np.int32)
            grown[:self.used] = self.rows[:self.used]
            self.rows = grown
        self.rows[self.used:need] = rows
        self.used = need
        self.keys, self.seconds = np.insert(self.keys, at, keys[order]), np.insert(self.seconds, at, seconds[order])
        self.starts = np.insert(self.starts, at, starts[order].astype(np.int32))
        self.sizes = np.insert(self.sizes, at, sizes[order].astype(np.int32))

    def encode(self, words: pa.LargeStringArray, learn) -> tuple[np.ndarray, np.ndarray]:
        """(rows of all words one after the other, number of each word's rows).  ``learn``
        gives the same for a list of words that are not known."""
        keys, seconds = self.hashes(words)
        place = self.find(keys, seconds)
        fresh = np.flatnonzero(place < 0)
        new_rows, new_sizes = learn(words.take(pa.array(fresh)).to_pylist()) if len(fresh) else (np.empty((0, self.width), np.int32), np.empty(0, np.int64))
        known = np.flatnonzero(place >= 0)
        sizes = np.empty(len(words), np.int64)
        sizes[known], sizes[fresh] = self.sizes[place[known]], new_sizes
        old_rows = self.rows[gather(self.starts.astype(np.int64), self.sizes.astype(np.int64), place[known])]
        both = np.concatenate([old_rows, new_rows])
        starts = np.empty(len(words), np.int64)
        for which, base in ((known, 0), (fresh, len(old_rows))):
            starts[which] = base + np.cumsum(sizes[which]) - sizes[which]
        rows = both[gather(starts, sizes, np.arange(len(words)))]
        if len(fresh):
            self.add(keys[fresh], seconds[fresh], new_sizes, new_rows)
        return rows, sizes
