"""Token ids of the ``word_bpe_49k`` tokenizer for whole Arrow columns.

The tokenizer never joins characters across white space, nor a letter with a
``.`` or ``,`` that ends a chunk, so a text's ids are those of such units, one
after another, and lower-casing them first changes nothing. Units are found and
hashed with numpy; the distinct new ones go to the tokenizer and are kept in a
table (hash, place, length) over one array of ids, from which all texts' ids
are gathered. New units of plain Latin letters go to the tokenizer's own BPE
model in joined calls without the normaliser (to which they are no work), every
other one through the whole tokenizer. ``tests/llm`` checks equality with plain
calls.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa

from ledgerlens.llm.common import flat_bytes
from ledgerlens.llm.rolling import LOWER, WHITE, HashIndex, ranges_hashed

NAME = "word_bpe_49k.json"
VOCABULARY = 49408  # ids 0 .. 49407
TABLE_UNITS = 2_000_000  # the table starts anew beyond this: a memory bound only


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(NAME)


def word_bounds(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of other than white space of all texts."""
    inside = ~WHITE[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = bounds[1:-1]
    first[borders[borders < len(raw)]] = inside[borders[borders < len(raw)]]
    before = borders[borders > 0] - 1
    last[before] = inside[before]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashed(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ascending ranges of bytes, A-Z in lower case."""
    return ranges_hashed(LOWER[raw], start, end)


def units(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of the units: words, without a single ``.`` or ``,`` after a
    letter at their end, which is a unit of its own."""
    start, end = word_bounds(raw, bounds)
    mark, one, two = raw[end - 1], raw[np.maximum(end - 2, 0)], raw[np.maximum(end - 3, 0)]
    low = one | 0x20
    letter = (low >= 0x61) & (low <= 0x7A) & (one < 0x80) & (end - start >= 2)
    # U+00C0 .. U+023F but the signs U+00D7 and U+00F7: two bytes.
    wide = (two >= 0xC3) & (two <= 0xC8) & (one >= 0x80) & (one <= 0xBF) & (end - start >= 3)
    wide &= ~((two == 0xC3) & ((one == 0x97) | (one == 0xB7)))
    cut = ((mark == 0x2E) | (mark == 0x2C)) & (letter | wide)
    extra = end[cut] - 1
    end = end.copy()
    end[cut] -= 1
    order = np.argsort(np.concatenate([start, extra]), kind="stable")
    return np.concatenate([start, extra])[order], np.concatenate([end, extra + 1])[order]


class Table:
    """Ids of units by hash: places and lengths in one array of ids."""

    def __init__(self):
        self.index = HashIndex()
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.places, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (-1: unknown) and lengths."""
        number = self.index.find(hashes)
        known = number >= 0
        place, length = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        place[known], length[known] = self.places[number[known]], self.lengths[number[known]]
        return place, length

    def add(self, hashes: np.ndarray, ids: list[np.ndarray], lengths: np.ndarray) -> None:
        """New hashes (distinct) with their ids, laid end to end."""
        flat = np.concatenate(ids).astype(np.uint32) if ids else np.zeros(0, np.uint32)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.places = np.concatenate([self.places, self.used + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.used += len(flat)
        self.index.add(hashes)

    def __len__(self) -> int:
        return len(self.index)


class WordIds:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = normalizers.Sequence([])
        split = pre_tokenizers.WhitespaceSplit()
        self.words.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # Bytes of plain ASCII letters are their own symbols.
        self.ascii = Tokenizer.from_file(path)
        self.ascii.normalizer, self.ascii.pre_tokenizer = normalizers.Sequence([]), split
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for piece, i in vocabulary.items():
            self.ends[i] = piece.endswith("</w>")
        self.table = Table()

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, new: list[str]) -> None:
        """Encode the distinct units ``new`` into the table."""
        kinds: tuple[list[int], list[int], list[int]] = ([], [], [])
        low = []
        for k, unit in enumerate(new):
            unit = unit.lower()
            low.append(unit)
            if not unit.isalpha() or len(unit) > 1000:
                kinds[2].append(k)
            elif unit.isascii():
                kinds[0].append(k)
            elif max(unit) < "ɐ":  # letters below U+0250 are the same under NFC
                kinds[1].append(k)
            else:
                kinds[2].append(k)
        for own, coder in ((kinds[0], self.ascii), (kinds[1], self.words)):
            for lo in range(0, len(own), 2000):
                part = own[lo : lo + 2000]
                ids = np.array(coder.encode_batch_fast([" ".join([low[k] for k in part])], add_special_tokens=False)[0].ids, np.uint32)
                ends = np.flatnonzero(self.ends[ids]) + 1
                self.table.add(hashes[part], [ids], np.diff(ends, prepend=0))
        for lo in range(0, len(kinds[2]), 500):
            part = kinds[2][lo : lo + 500]
            found = [np.array(ids, np.uint32) for ids in self._plain([new[k] for k in part])]
            self.table.add(hashes[part], found, np.array([len(x) for x in found], np.int64))

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column (null: empty) laid end to end, and
        their bounds (length + 1)."""
        raw, bounds = flat_bytes(column)
        if b"<|" in raw.tobytes():  # may hold the text of a special token, which lower-casing would touch
            each = [np.array(x, np.uint32) for x in self._plain([t or "" for t in column.to_pylist()])]
            return np.concatenate([np.zeros(0, np.uint32), *each]), np.cumsum([0, *map(len, each)])
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        start, end = units(raw, bounds)
        distinct, first, of = np.unique(hashed(raw, start, end), return_index=True, return_inverse=True)
        place, length = self.table.find(distinct)
        if (place < 0).any():
            if len(self.table) > TABLE_UNITS:
                self.table = Table()
                place[:] = -1
            unknown = np.flatnonzero(place < 0)
            blob = raw.tobytes()
            new = [blob[a:b].decode() for a, b in zip(start[first[unknown]].tolist(), end[first[unknown]].tolist(), strict=True)]
            self._learn(distinct[unknown], new)
            place, length = self.table.find(distinct)
        place, length = place[of], length[of]
        after = np.cumsum(length)
        flat = self.table.ids[np.repeat(place - (after - length), length) + np.arange(after[-1] if len(after) else 0)]
        return flat, np.concatenate([[0], after])[np.searchsorted(start, bounds)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        flat, bounds = self.encode_column(pa.array(texts, pa.large_string()))
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One tokenizer and table in each Python worker."""
    return WordIds(path)
