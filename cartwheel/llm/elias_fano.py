"""Elias-Fano sequences and an n-gram trie of them, kept as memory-mapped files.

A monotone sequence of m integers below u takes about 2 + log2(u / m) bits an
entry: low bits packed, high bits in unary.  The trie has one level for each
order.  A level's entries are grouped by parent; words within a group rise, and
adding the last value of the group before makes the level one monotone sequence.
A pointer sequence (monotone too) gives each entry's group of children.  A word
is found among its context's successors by looking for the first entry of the
group that is not less than it.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np


class EliasFano:
    """A monotone, non-negative sequence."""

    def __init__(self, size: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.size, self.low_bits, self.low, self.high = size, low_bits, low, high

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        m = len(values)
        if not m:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8))
        low_bits = max(0, (int(values[-1]) // m).bit_length() - 1)
        bits = np.empty((m, low_bits), np.uint8)
        for b in range(low_bits):
            bits[:, b] = (values >> np.uint64(b)) & np.uint64(1)
        unary = np.zeros(m + int(values[-1] >> np.uint64(low_bits)) + 1, np.uint8)
        unary[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(m)] = 1
        return cls(m, low_bits, np.packbits(bits.ravel(), bitorder="little"), np.packbits(unary, bitorder="little"))

    def save(self, path: Path) -> None:
        self.low.tofile(path.with_suffix(".low"))
        self.high.tofile(path.with_suffix(".high"))
        path.with_suffix(".size").write_text(f"{self.size} {self.low_bits}")

    @classmethod
    def open(cls, path: Path) -> "EliasFano":
        size, low_bits = map(int, path.with_suffix(".size").read_text().split())
        low, high = (np.memmap(f, np.uint8, "r") if f.stat().st_size else np.zeros(0, np.uint8)
                     for f in (path.with_suffix(".low"), path.with_suffix(".high")))
        return cls(size, low_bits, low, high)

    def values(self) -> np.ndarray:
        """The sequence: select of all ones, and the low bits."""
        if not self.size:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.size]
        out = (ones - np.arange(self.size)) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(self.low, count=self.size * self.low_bits, bitorder="little")
            for b in range(self.low_bits):
                out |= bits[b::self.low_bits].astype(np.int64) << b
        return out


def quantise(values: np.ndarray, bits: int = 12) -> tuple[np.ndarray, float, float]:
    """Equal bins between least and most: codes, the first bin's value, the step."""
    if not len(values):
        return np.zeros(0, np.uint16), 0.0, 0.0
    lo, hi = float(values.min()), float(values.max())
    step = (hi - lo) / ((1 << bits) - 1)
    codes = np.rint((values - lo) / step).astype(np.uint16) if step else np.zeros(len(values), np.uint16)
    return codes, lo, step


class Level:
    """Words grouped by parent, pointers to the children's groups, quantised values."""

    def __init__(self, words: EliasFano, pointers: EliasFano, tables: dict[str, tuple[np.ndarray, float, float]]):
        self.words, self.pointers, self.tables = words, pointers, tables

    def look_up(self, name: str, at: np.ndarray) -> np.ndarray:
        codes, lo, step = self.tables[name]
        return lo + step * codes[at]


def build_level(folder: Path, parents: np.ndarray, words: np.ndarray, n_parents: int,
                tables: dict[str, np.ndarray]) -> None:
    """Write the level of entries (parent, word), sorted by both."""
    folder.mkdir()
    starts = np.searchsorted(parents, np.arange(n_parents + 1))
    EliasFano.encode(starts).save(folder / "pointers")
    EliasFano.encode(words + _bases(starts, words)[parents]).save(folder / "words")
    for name, values in tables.items():
        codes, lo, step = quantise(values)
        codes.tofile(folder / f"{name}.codes")
        (folder / f"{name}.scale").write_text(f"{lo!r} {step!r}")


def _bases(starts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each group, the sum of the last words of the groups before it."""
    last = np.where(starts[1:] > starts[:-1], words[np.maximum(starts[1:] - 1, 0)] if len(words) else 0, 0)
    return np.concatenate([[0], np.cumsum(last)[:-1]]) if len(last) else np.zeros(0, np.int64)


def open_level(folder: Path) -> Level:
    tables = {}
    for scale in folder.glob("*.scale"):
        lo, step = map(float, scale.read_text().split())
        codes = scale.with_suffix(".codes")
        tables[scale.stem] = (np.memmap(codes, np.uint16, "r") if codes.stat().st_size else np.zeros(0, np.uint16),
                              lo, step)
    return Level(EliasFano.open(folder / "words"), EliasFano.open(folder / "pointers"), tables)


class Trie:
    """Levels from the first word on; search answers many sorted n-grams at once."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def search(self, grams: list[np.ndarray]) -> list[np.ndarray]:
        """For n-grams given word by word: each level's entry number, -1 from the first miss on."""
        out, parent = [], np.zeros(len(grams[0]), np.int64)
        for level, words in zip(self.levels, grams):
            stored, starts = level.words.values(), level.pointers.values()
            if not len(stored):
                parent = np.full(len(words), -1)
                out.append(parent)
                continue
            ends_at = np.maximum(starts[1:] - 1, 0)
            filled = starts[1:] > starts[:-1]
            # base of a group: the last stored value of the groups before it
            last = np.maximum.accumulate(np.where(filled, stored[ends_at], 0))
            base = np.concatenate([[0], last[:-1]])
            known = parent >= 0
            of = np.where(known, parent, 0)
            goal = words + base[of]
            # the last of one group may equal the first of the next: clip into the own group
            at = np.clip(np.searchsorted(stored, goal), starts[of], np.maximum(starts[of + 1] - 1, 0))
            hit = known & (starts[of + 1] > starts[of]) & (stored[at] == goal)
            parent = np.where(hit, at, -1)
            out.append(parent)
        return out
