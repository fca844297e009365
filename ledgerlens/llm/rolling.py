"""Polynomial hashes of substrings of a byte array, and byte classes."""

from __future__ import annotations

import numpy as np

from ledgerlens.llm.common import mix64

WHITE = np.zeros(256, bool)  # 0x20, 0x09-0x0D
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)  # A-Z to a-z
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 5  # odd: invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 .. n."""
    size = 1 << max(10, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        out = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, np.uint64(base), np.uint64)
            table[0] = 1
            out.append(np.multiply.accumulate(table))
        _powers[size] = tuple(out)
    return _powers[size]


class Rolling:
    """Hashes of all substrings of a byte array from prefix sums."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _power_tables(len(raw) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=np.uint64)])

    def every(self, size: int) -> np.ndarray:
        """Hash of each substring of ``size`` bytes, by start."""
        n = len(self.sums) - size
        return mix64((self.sums[size:] - self.sums[:n]) * self.down[:n])

    def some(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


STEP = 1 << 18  # bytes hashed at a time


def ranges_hashed(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ascending ranges of bytes."""
    hashes = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        # Ranges that end within a step of the first one (one at least).
        stop = max(at + 1, int(np.searchsorted(end, start[at] + STEP, side="right")))
        base = int(start[at])
        hashes[at:stop] = Rolling(raw[base : int(end[stop - 1])]).some(start[at:stop] - base, end[at:stop] - base)
        at = stop
    return hashes


class HashIndex:
    """Numbers of distinct hashes in the order they were added; two sorted runs."""

    def __init__(self):
        self.runs = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]
        self.size = 0

    def __len__(self) -> int:
        return self.size

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 if it is unknown."""
        out = np.full(len(hashes), -1, np.int64)
        for known, numbers in self.runs:
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                out[hit] = numbers[at[hit]]
        return out

    def add(self, hashes: np.ndarray) -> None:
        main, recent = self.runs
        recent = self._merged(recent, (hashes, self.size + np.arange(len(hashes))))
        self.size += len(hashes)
        if len(recent[0]) > max(50_000, len(main[0]) // 4):
            main, recent = self._merged(main, recent), tuple(x[:0] for x in recent)
        self.runs = [main, recent]

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        both = [np.concatenate(x) for x in zip(a, b, strict=True)]
        order = np.argsort(both[0], kind="stable")
        return tuple(x[order] for x in both)
