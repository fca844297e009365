"""Sequence packing by swap-based local search.

Documents become pieces of at most ``capacity`` tokens; whole pieces fill a
sequence each, the rest are packed into as few sequences as possible. Pieces
are dealt into groups of bounded size; in a group, a best-fit start is improved
by local search on its underfull bins: an item moves, or is exchanged one for
one or two for one, whenever that raises the sum of squared fills, so the
emptiest bin drains until it is gone. The least filled bins of each group then
meet those of other groups, again in bounded groups, until one group is left;
so each level, not each group, keeps a partly filled bin.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import wordids
from ledgerlens.llm.common import text_slices, written

CAPACITY = 4096
GROUP_ITEMS = 20_000
RELEASED_BINS = 8  # least filled bins that a group hands to the next level
FAN_IN = 64  # groups of a level that meet in one of the next
PAIR_BIN_ITEMS = 40  # bins of more items take part in moves and one-for-one exchanges only

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECES_IDS = f"{PIECES}, ids array<int>"
BATCH_IDS = 1 << 20  # ids of an Arrow batch at most, but for one document


def pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of each document (its ids, then ``end_id``), with
    the ids and their checksum (as little-endian u32)."""
    path = tokenizer or wordids.default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = wordids.word_ids(path), np.array([end_id], np.uint32)
        for batch in batches:
            for lo, hi in text_slices(batch):
                part, rows, held, size = batch.slice(lo, hi - lo), [], [], 0
                flat, bound = coder.encode_column(part.column("text"))
                for d, a, b in zip(part.column("doc_id").to_pylist(), bound[:-1].tolist(), bound[1:].tolist(), strict=True):
                    ids = np.concatenate([flat[a:b], end]).astype("<u4")
                    held.append(ids)
                    size += len(ids)
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        own = ids[at : at + capacity]
                        rows.append((d, k, at, len(own), zlib.crc32(own.tobytes())))
                    if size > BATCH_IDS:
                        yield made(rows, held)
                        rows, held, size = [], [], 0
                if rows:
                    yield made(rows, held)

    def made(rows: list[tuple], held: list[np.ndarray]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        ends = pa.array(np.cumsum([0, *cols[3]]), pa.int32())
        ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(held).astype(np.int32), pa.int32()))
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), ids], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        )

    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(cut, PIECES_IDS)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: longest first, each into the fullest bin that has room."""
    bins = np.empty(len(lengths), np.int64)
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        at = bisect_left(room, (n, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = capacity, made
            made += 1
        bins[i] = b
        if free > n:
            insort(room, (free - n, b))
    return bins


def local_search(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Raise the sum of squared fills by moves and exchanges between underfull
    bins until no step does, or only one underfull bin is left.

    Every step takes tokens from the emptiest bin (the donor) to a fuller one:
    an item moves; an item goes for a shorter one; an item goes for two whose
    sum is shorter; two go for a shorter one. The sum of squares is an integer
    that grows with each step, so the search ends.
    """
    bins = bins.copy()
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    stuck: set[int] = set()
    while True:
        under = np.flatnonzero((fill < capacity) & (fill > 0))
        donors = [b for b in under[np.argsort(fill[under], kind="stable")] if int(b) not in stuck]
        if len(under) < 2 or not donors:
            return bins
        donor = int(donors[0])
        if not _drain(lengths, bins, fill, under, donor, capacity):
            stuck.add(donor)
        else:
            stuck.clear() if fill[donor] == 0 else None


def _drain(lengths: np.ndarray, bins: np.ndarray, fill: np.ndarray, under: np.ndarray, donor: int, capacity: int) -> bool:
    """One best step that takes tokens out of ``donor``; False if there is none."""
    free = np.full(len(fill), -1, np.int64)
    free[under] = capacity - fill[under]
    free[donor] = -1
    free[fill < fill[donor]] = -1
    own = np.flatnonzero(bins == donor)
    others = np.flatnonzero(free[bins] > 0)
    targets = np.flatnonzero(free > 0)
    best, step = 0, None

    def gain(to: np.ndarray, d: np.ndarray) -> np.ndarray:
        return 2 * d * (fill[to] - fill[donor] + d)

    def consider(to: np.ndarray, d: np.ndarray, ok: np.ndarray, make) -> None:
        nonlocal best, step
        if ok.any():
            g = np.where(ok, gain(to, d), 0)
            k = int(g.argmax())
            if g[k] > best:
                best, step = int(g[k]), make(k)

    items = sorted({int(lengths[i]): int(i) for i in own}.items())
    olen, obin = lengths[others], bins[others]
    pair_a, pair_b = _pairs(others, obin)
    plen, pbin = lengths[pair_a] + lengths[pair_b], bins[pair_a]
    for n, i in items:
        d = np.full(len(targets), n)
        consider(targets, d, d <= free[targets], lambda k, i=i: ([i], [], int(targets[k])))
        d = n - olen
        consider(obin, d, (d > 0) & (d <= free[obin]), lambda k, i=i: ([i], [int(others[k])], int(obin[k])))
        d = n - plen
        consider(pbin, d, (d > 0) & (d <= free[pbin]), lambda k, i=i: ([i], [int(pair_a[k]), int(pair_b[k])], int(pbin[k])))
    if len(own) <= PAIR_BIN_ITEMS:
        for x in range(len(own)):
            for y in range(x + 1, len(own)):
                n = int(lengths[own[x]] + lengths[own[y]])
                d = n - olen
                two = [int(own[x]), int(own[y])]
                consider(obin, d, (d > 0) & (d <= free[obin]), lambda k, two=two: (two, [int(others[k])], int(obin[k])))
    if step is None:
        return False
    out, back, to = step
    moved = int(lengths[out].sum() - (lengths[back].sum() if back else 0))
    bins[out], fill[to], fill[donor] = to, fill[to] + moved, fill[donor] - moved
    if back:
        bins[back] = donor
    return True


def _pairs(items: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of items of the same bin, for bins of few items."""
    order = np.argsort(of, kind="stable")
    items, of = items[order], of[order]
    a, b = [], []
    for gap in range(1, PAIR_BIN_ITEMS):
        same = np.flatnonzero(of[gap:] == of[:-gap]) if len(of) > gap else np.zeros(0, np.int64)
        if not len(same):
            break
        a.append(items[same])
        b.append(items[same + gap])
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(a), np.concatenate(b)


def pack_group(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Bin numbers of the items of one group."""
    return local_search(lengths, best_fit(lengths, capacity), capacity) if len(lengths) else np.zeros(0, np.int64)


def pack(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Add sequence_id and offset to pieces (column length, 1 .. capacity).

    The result has one row a piece; offsets run gapless from 0 in a sequence.
    Repeated rows are pieces of their own. An empty table stays empty.
    """
    names = items.columns
    numbered = written(items.select("*", F.monotonically_increasing_id().alias("_item")), "pack-pieces")
    whole = numbered.filter(F.col("length") >= capacity).select("_item", F.col("_item").alias("_bin"), F.lit(0).alias("offset").cast("long"))
    rest = numbered.filter(F.col("length") < capacity).select("_item", "length")
    n = rest.count()
    groups, level, done = -(-n // group_items), 0, []
    rest = rest.withColumn("_group", F.expr(f"pmod(xxhash64(_item), {max(1, groups)})"))
    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while groups:
        last = groups == 1

        def group(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("_item", ignore_index=True)
            lengths = pdf["length"].to_numpy(np.int64)
            bins = pack_group(lengths, capacity)
            fill = np.bincount(bins, weights=lengths)
            used = np.flatnonzero(fill)
            loose = np.zeros(len(fill), bool)
            if not last:
                low = used[np.argsort(fill[used], kind="stable")][:RELEASED_BINS]
                loose[low[fill[low] < capacity]] = True
            order = np.lexsort((pdf["_item"].to_numpy(), bins))
            offset = np.zeros(len(bins), np.int64)
            sums = np.cumsum(lengths[order]) - lengths[order]
            first = np.r_[True, bins[order][1:] != bins[order][:-1]]
            offset[order] = sums - np.maximum.accumulate(np.where(first, sums, 0))
            # A sequence is named after its first item: distinct at every level.
            lead = np.full(len(fill), -1, np.int64)
            lead[bins[order][first]] = pdf["_item"].to_numpy()[order][first]
            return pd.DataFrame(
                {"_item": pdf["_item"], "length": lengths, "_group": pdf["_group"], "_bin": lead[bins], "offset": offset, "_loose": loose[bins]}
            )

        packed = written(
            # By number, so that groups (few bytes, much work) are not coalesced into few tasks.
            rest.repartition(min(parts, groups), "_group").groupBy("_group").applyInPandas(group, "_item long, length long, _group long, _bin long, offset long, _loose boolean"),
            f"pack-level-{level}",
        )
        done.append(packed.filter("NOT _loose").select("_item", "_bin", "offset"))
        if last:
            break
        groups, level = -(-groups // FAN_IN), level + 1
        rest = packed.filter("_loose").selectExpr("_item", "length", f"pmod(_group, {groups}) AS _group")
    placed = whole
    for d in done:
        placed = placed.unionByName(d)
    return numbered.join(placed, "_item").select(*names, F.col("_bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text; other columns are ignored) with their
    place: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset. The
    ids of a sequence are those of its pieces by offset.

    A null or empty text is one piece of the end id. A null doc_id stays null.
    """
    return pack(pieces(docs, tokenizer, end_id, capacity), capacity)
