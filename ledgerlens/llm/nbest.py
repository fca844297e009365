"""N-best SentencePiece segmentation by A* with exact heuristics.

The lattice of a text has a node before each character and an edge for each
vocabulary piece that fits there (or the bytes of a character that no piece
covers). A forward Viterbi pass gives the best score from the start to every
node; searching backwards from the end, those scores are exact heuristics, so
A* pops complete segmentations best first and expands little else.

No piece spans the start of a word, so lattices of texts fall apart into those
of their words. The forward pass runs over all new words of a slice at once, with
the best two scores of every node: they tell what a word's second choice costs.
The N best segmentations of a text differ from its best one in the N - 1 words
where that costs least only; the A* search runs for those.

The model file holds merge ranks, not probabilities: pieces are scored by
Zipf's law, -ln(rank + 2), and each byte of an uncovered character like the
rarest piece.
"""

from __future__ import annotations

import functools
import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.common import text_slices
from ledgerlens.llm.rolling import HashIndex, ranges_hashed

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
N_BEST = 4
KNOWN_WORDS = 1_500_000  # the table of words starts anew beyond this: a memory bound only
SEARCHED_WORDS = 20_000  # so does the cache of searched words
LONG_WORD = 48  # longer words pass through the lattice one by one

Found = list[tuple[float, tuple[int, ...]]]  # (score, ids), best first


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Lattice:
    def __init__(self, model: str, n: int = N_BEST):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.n, self.searched = n, {}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        own = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        ranked = sorted(own, key=lambda i: (-sp.get_score(i), i))
        piece = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.edges = {piece[i]: (-math.log(r + 2), i) for r, i in enumerate(ranked)}
        if any(SPACE in p.lstrip(SPACE) for p in self.edges):
            raise ValueError("a piece spans the start of a word")
        self.longest = max(map(len, self.edges))
        self.byte_score = -math.log(len(ranked) + 2)
        # What each piece decodes to.
        self.raw = [p.replace(SPACE, " ").encode() for p in piece]
        for b, i in enumerate(self.byte):
            self.raw[i] = bytes([b])
        # Pieces by length: sorted hashes of their characters, scores, ids.
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in range(1, self.longest + 1):
            some = [p for p in self.edges if len(p) == size]
            if some:
                hashes = _rows_hashed(np.array(some, dtype=f"U{size}").view(np.uint32).reshape(len(some), size))
                order = np.argsort(hashes)
                self.by_length[size] = (hashes[order], np.array([self.edges[p][0] for p in some])[order], np.array([self.edges[p][1] for p in some])[order])
        self._forget()

    def _forget(self) -> None:
        """Start the table of words: scores, cost of the second choice, ids."""
        self.index = HashIndex()
        self.best, self.gap, self.end = ([np.zeros(0)], [np.zeros(0)], [np.zeros(1, np.int64)])
        self.ids = [np.zeros(0, np.uint32)]

    def _into(self, word: str, end: int) -> list[tuple[int, float, tuple[int, ...]]]:
        """Edges that end at ``end``: (start, score, ids)."""
        found = []
        for start in range(max(0, end - self.longest), end):
            edge = self.edges.get(word[start:end])
            if edge is not None:
                found.append((start, edge[0], (edge[1],)))
        if not found or found[-1][0] != end - 1:
            raw = _literal(word[end - 1]).encode("utf-8", "surrogatepass")
            found.append((end - 1, self.byte_score * len(raw), tuple(self.byte[b] for b in raw)))
        return found

    def word(self, word: str) -> Found:
        """The N best segmentations of a word; ties by ids."""
        size = len(word)
        into = [self._into(word, end) for end in range(1, size + 1)]
        best = [0.0] + [-math.inf] * size
        for end in range(1, size + 1):
            best[end] = max(best[start] + score for start, score, _ in into[end - 1])
        out: Found = []
        heap = [(-best[size], (), 0.0, size)]
        while heap and len(out) < self.n:
            _, ids, behind, node = heapq.heappop(heap)
            if node == 0:
                out.append((behind, ids))
                continue
            for start, score, own in into[node - 1]:
                heapq.heappush(heap, (-(best[start] + score + behind), own + ids, score + behind, start))
        return out

    def _search(self, word: str) -> Found:
        found = self.searched.get(word)
        if found is None:
            if len(self.searched) >= SEARCHED_WORDS:
                self.searched.clear()
            found = self.searched[word] = self.word(word)
        return found

    def _forward(self, words: list[str], size: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(best score, cost of the second choice, best ids) of words of one
        length: the forward pass for all at once."""
        w = len(words)
        chars = np.array(words, dtype=f"U{size}").view(np.uint32).reshape(w, size)
        top = np.full((size + 1, w), -np.inf)
        second = np.full((size + 1, w), -np.inf)
        step, edge = np.zeros((size + 1, w), np.int64), np.full((size + 1, w), -1, np.int64)
        top[0] = 0.0
        wide = _byte_counts(chars)
        for end in range(1, size + 1):
            rolled = np.zeros(w, np.uint64)
            factor = np.uint64(1)
            for length in range(1, min(end, self.longest) + 1):
                # the hash grows by characters before it
                rolled = rolled + chars[:, end - length].astype(np.uint64) * factor
                factor = np.uint64(int(factor) * _BASE & (2**64 - 1))
                if length not in self.by_length:
                    continue
                known, scores, ids = self.by_length[length]
                at = np.minimum(np.searchsorted(known, rolled), len(known) - 1)
                hit = known[at] == rolled
                score = np.where(hit, scores[at], -np.inf)
                piece = np.where(hit, ids[at], -1)
                if length == 1:
                    score = np.where(hit, score, self.byte_score * wide[:, end - 1])
                first = top[end - length] + score
                better = first > top[end]
                second[end] = np.maximum(np.maximum(second[end], np.minimum(first, top[end])), second[end - length] + score)
                top[end] = np.where(better, first, top[end])
                step[end], edge[end] = np.where(better, length, step[end]), np.where(better, piece, edge[end])
        back = np.full((size, w), -2, np.int64)  # ids from the end on; -1: bytes of a character, -2: nothing
        place = np.zeros((size, w), np.int64)
        node, row = np.full(w, size), np.arange(w)
        for k in range(size):
            live = node > 0
            back[k, live] = edge[node[live], row[live]]
            node = node - np.where(live, step[node, row], 0)
            place[k] = node
        out = []
        plain = (back != -1).all(axis=0)
        used = (back != -2).sum(axis=0)
        for i in range(w):
            path = back[: used[i], i][::-1]
            if not plain[i]:
                spread: list[int] = []
                for piece, at in zip(path.tolist(), place[: used[i], i][::-1].tolist(), strict=True):
                    spread += [piece] if piece >= 0 else [self.byte[b] for b in _literal(words[i][at]).encode("utf-8", "surrogatepass")]
                path = np.array(spread)
            out.append(path.astype(np.uint32))
        return top[size], top[size] - second[size], out

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Add new words to the table."""
        by_size: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            by_size.setdefault(len(word) if len(word) <= LONG_WORD else 0, []).append(k)
        for size, own in by_size.items():
            if size:
                best, gap, ids = self._forward([words[k] for k in own], size)
            else:
                found = [self.word(words[k]) for k in own]
                best = np.array([f[0][0] for f in found])
                gap = np.array([f[0][0] - f[1][0] if len(f) > 1 else math.inf for f in found])
                ids = [np.array(f[0][1], np.uint32) for f in found]
            self.index.add(hashes[own])
            last = self.end[-1][-1]
            self.best.append(best)
            self.gap.append(gap)
            self.ids.append(np.concatenate(ids))
            self.end.append(last + np.cumsum([len(x) for x in ids]))
        for name in ("best", "gap", "ids", "end"):
            setattr(self, name, [np.concatenate(getattr(self, name))])

    def segment_all(self, texts: list[str]) -> list[tuple[Found, bool]]:
        """The N best segmentations of whole texts, best first, and whether they
        all decode to the text."""
        rows = [b" " + t.encode() for t in texts]
        raw = np.frombuffer(b"".join(rows), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        space = raw == 0x20
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[bounds[:-1]] = True
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(raw))
        distinct, where, of = np.unique(ranges_hashed(raw, start, end), return_index=True, return_inverse=True)
        if len(self.index) > KNOWN_WORDS:
            self._forget()
        new = self.index.find(distinct) < 0
        blob = raw.tobytes()
        if new.any():
            self._learn(distinct[new], [_marked(blob[a:b]) for a, b in zip(start[where[new]].tolist(), end[where[new]].tolist(), strict=True)])
        entry = self.index.find(distinct)[of]
        gap, best, stop = self.gap[0][entry], self.best[0][entry], self.end[0][entry + 1]
        size = stop - self.end[0][entry]
        after = np.concatenate([[0], np.cumsum(size)])
        flat = self.ids[0][np.repeat(stop - after[1:], size) + np.arange(after[-1])]
        out = []
        for k, (a, b) in enumerate(zip(np.searchsorted(start, bounds[:-1]).tolist(), np.searchsorted(start, bounds[1:]).tolist(), strict=True)):
            ids, cut = flat[after[a] : after[b]], after[a : b + 1] - after[a]
            decodes = b"".join(map(self.raw.__getitem__, ids.tolist())) == rows[k]
            near = [int(i) for i in np.argsort(gap[a:b], kind="stable")[: self.n - 1] if gap[a + i] < math.inf]
            words = [blob[start[a + i] : end[a + i]] for i in near]
            choices = [self._search(_marked(w)) for w in words]
            decodes &= all(b"".join(self.raw[i] for i in own) == w for w, c in zip(words, choices, strict=True) for _, own in c)
            # (cost over the best, choice of each of the near words)
            combined: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
            for c in choices:
                combined = heapq.nsmallest(
                    self.n, ((cost + c[0][0] - s, (*picked, j)) for cost, picked in combined for j, (s, _) in enumerate(c))
                )
            total, order = math.fsum(best[a:b]), np.argsort(near)
            found = []
            for cost, picked in combined[: self.n]:
                parts, at = [], 0
                for m in order:
                    parts += [ids[at : cut[near[m]]], np.array(choices[m][picked[m]][1], np.uint32)]
                    at = cut[near[m] + 1]
                found.append((total - cost, np.concatenate([*parts, ids[at:]])))
            out.append((found, decodes))
        return out

    def segment(self, text: str) -> Found:
        """The N best segmentations of a whole text, best first."""
        return [(s, tuple(ids.tolist())) for s, ids in self.segment_all([text])[0][0]]

    def decode(self, ids: tuple[int, ...]) -> str:
        """The text of a segmentation (the inverse of ``segment``)."""
        return b"".join(self.raw[i] for i in ids).decode()[1:]


_BASE = 0x9E3779B97F4A7C15 | 5


def _rows_hashed(chars: np.ndarray) -> np.ndarray:
    """A hash of each row of characters, last character first."""
    out, factor = np.zeros(len(chars), np.uint64), 1
    for k in range(chars.shape[1] - 1, -1, -1):
        out = out + chars[:, k].astype(np.uint64) * np.uint64(factor)
        factor = factor * _BASE & (2**64 - 1)
    return out


def _byte_counts(chars: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of each character; the stand-in has those of U+2581."""
    return 1 + (chars >= 0x80) + (chars >= 0x800).astype(np.int64) + (chars >= 0x10000)


# A U+2581 of the text itself must not decode to a space: while segmenting it
# stands as a lone surrogate, which no valid text holds, and is encoded as bytes.
_STAND_IN = "\udc81"


def marked(text: str) -> str:
    """The text with its word marks: one before it, one for each space."""
    return SPACE + text.replace(SPACE, _STAND_IN).replace(" ", SPACE)


def _marked(word: bytes) -> str:
    """The same for bytes that hold the space before them already."""
    return word.decode().replace(SPACE, _STAND_IN).replace(" ", SPACE)


def _literal(char: str) -> str:
    return SPACE if char == _STAND_IN else char


@functools.lru_cache(maxsize=2)
def lattice(model: str, n: int) -> Lattice:
    return Lattice(model, n)


OUT = "doc_id long, n_found int, best_score double, scores array<double>, n_pieces long, ids_crc32 array<long>, decodes boolean, ids array<array<int>>"
BATCH_IDS = 1 << 20  # ids of an Arrow batch at most, but for one row


def _nested(rows: list[list[np.ndarray]]) -> pa.Array:
    """Lists of arrays of ids as an Arrow column."""
    each = [ids for own in rows for ids in own]
    flat = pa.array(np.concatenate([np.zeros(0, np.int32), *each]), pa.int32())
    inner = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, each)]), pa.int32()), flat)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), inner)


def encode(docs: DataFrame, model: str | None = None, n: int = N_BEST) -> DataFrame:
    """The N best segmentations of every whole text (doc_id, text; other
    columns are ignored): their number, scores, the pieces of the best one, the
    checksum of each (ids as little-endian u32), whether all decode to the text,
    and the ids of each, best first (``decode`` is the way back). A null or empty
    text has the one segmentation of its word mark."""
    path = model or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(path, n)
        for batch in batches:
            for lo, hi in text_slices(batch):
                part, rows, every = batch.slice(lo, hi - lo), [], []
                for found, decodes in own.segment_all([t or "" for t in part.column("text").to_pylist()]):
                    rows.append((
                        len(found), found[0][0], [s for s, _ in found], len(found[0][1]),
                        [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in found], decodes,
                    ))
                    every.append([ids.astype(np.int32) for _, ids in found])
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.list_(pa.int64()), pa.bool_()]
                whole = [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))]
                size = np.cumsum([sum(map(len, x)) for x in every])
                at = 0
                while at < len(every):
                    end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_IDS, side="right")))
                    yield pa.RecordBatch.from_arrays(
                        [*(c.slice(at, end - at) for c in whole), _nested(every[at:end])],
                        names=["doc_id", "n_found", "best_score", "scores", "n_pieces", "ids_crc32", "decodes", "ids"],
                    )
                    at = end

    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(run, OUT)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The texts of segmentations (doc_id, ids as ``encode`` gives them; other
    columns are ignored): doc_id and texts, one of each segmentation. Null ids
    have null texts; rows may repeat."""
    path = model or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(path, N_BEST)
        for batch in batches:
            texts = [None if found is None else [None if ids is None else own.decode(tuple(ids)) for ids in found] for found in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.list_(pa.string()))], names=["doc_id", "texts"])

    return encoded.selectExpr("CAST(doc_id AS long) AS doc_id", "ids").mapInArrow(run, "doc_id long, texts array<string>")
