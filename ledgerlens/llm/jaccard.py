"""Word-shingle Jaccard join with signature trees, and its components.

Two texts link when the Jaccard similarity of their shingle sets is at least
``PERCENT`` / 100. Exact, in these steps:

1. Documents with the same shingle set are one node (128-bit fingerprint). A set
   linked to one of n shingles shares ceil(P n) of them with it, so a node of
   which n - ceil(P n) + 1 shingles stand in no other text is left aside: most
   are, and all that follows grows with the others only.
2. Shingles are put in one order for all (the most frequent last, then by the
   count of nodes that hold them, then by hash). Linked sets share one of the
   first n - ceil(P n) + 1. Those go to buckets by hash, as packed arrays, each
   node once for each bucket it has shingles in.
3. In a bucket, nodes that share such a shingle meet. Up to ``LEAF`` of them
   are paired at once, if sizes, the places of the shared shingle and token bitmaps
   allow a link (as two leaves of step 4 would be). Larger groups are joined up with those they overlap, over
   all buckets, to families. Shingles that very many nodes may hold are dealt by
   node, and their parts are joined up by a node that stands for the shingle.
4. Each block is a signature tree: a node holds the OR of the token bitmaps
   below it and the range of set sizes. Two trees are traversed together, and
   pairs of nodes are left aside whose largest possible overlap is too small;
   remaining pairs of texts are compared, unless they are connected already.
   A family of several blocks is dealt twice by hash and linked inside each
   block; then only blocks that may hold nodes of different components meet,
   each pair of blocks in a group of its own.
5. The pairs of step 3 are compared text by text: first one partner for each
   node, then only pairs that are not connected yet.

The most frequent shingles are found on a sample of whole texts, the others are
counted on all nodes that are left; they decide the order only, and any order
gives the same links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import flat_bytes, text_slices, written
from ledgerlens.llm.components import components
from ledgerlens.llm.shingles import shingle_sets

PERCENT = 75
SAMPLE_SHARE = 16  # one text of so many is counted for the order
FREQUENT = 1 << 18  # bound of the list of frequent shingles (8 bytes each)
LEAST_COUNT = 4  # counts in the sample that make a shingle frequent
LEAF = 64  # nodes of a tree's leaf; groups of this size are paired directly
FAN_OUT = 8
BLOCK = 2048  # nodes of a tree
DENSE = 8  # bits a shingle of the bitmaps in trees
TREE_WORDS = 512  # 64-bit words of a tree's bitmaps at most: wider ones are folded
COMPARED_WORDS = 1 << 20  # words of bitmaps compared at a time
MET_PAIRS = 1 << 18  # pairs of nodes that share a shingle, tested at a time
SLICE = 4 << 20  # bytes of text whose shingles are packed together
HOT_COUNT = 6250  # counts in the sample from which a shingle's nodes are dealt (100,000 texts)
HOT_PARTS = 64  # parts of the nodes of such a shingle
SLICE_NODES = 1 << 16  # nodes of a slice, numbered in two bytes


def least_overlap(n, percent: int = PERCENT):
    """Least shared shingles of a set of n shingles with any set it links to."""
    return (percent * n + 99) // 100


def linked(shared, n, m, percent: int = PERCENT):
    return 100 * shared >= percent * (n + m - shared)


def signature(shingles: np.ndarray, density: int = 1) -> bytes:
    """Token bitmap: a power of two of bits, 64 at least and from one to two
    times ``density`` for each shingle."""
    bits = max(64, 1 << max(0, int(density * len(shingles) - 1).bit_length()))
    marks = np.zeros(bits, np.uint8)
    marks[(shingles >> np.uint64(20)) & np.uint64(bits - 1)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def fold(marks: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of uint64) folded to ``words`` words each by OR: the bitmap
    that fewer bits would have given."""
    return np.bitwise_or.reduce(marks.reshape(len(marks), -1, words), axis=1) if marks.shape[1] > words else marks


class Tree:
    """Signature tree over nodes (sizes, bitmaps of any widths).

    Level 0 holds the nodes in order of size, every further level groups of
    ``LEAF`` and then ``FAN_OUT`` of the level below; each entry has the OR of
    its bitmaps at one common width, the range of sizes and the most tokens that
    one of its sets loses to shared bits."""

    def __init__(self, sizes: np.ndarray, marks: list[bytes], words: int):
        self.order = np.argsort(sizes, kind="stable")
        own = [marks[i] for i in self.order]
        rows = np.zeros((len(own), words), np.uint64)
        lost = np.zeros(len(own), np.int64)
        for k, m in enumerate(own):
            full = np.frombuffer(m, np.uint64)[None, :]
            if full.shape[1] < words:
                # A narrow bitmap says nothing of the higher hash bits: repeat it.
                rows[k] = np.tile(full[0], words // full.shape[1])
            else:
                rows[k] = fold(full, words)[0]
        n = sizes[self.order].astype(np.int64)
        self.wide = np.array([len(m) // 8 for m in own])
        # A set has at most as many tokens in a bit pattern as bits it matches,
        # and those that share a bit with another of its tokens.
        bits = np.bitwise_count(rows).sum(axis=1).astype(np.int64)
        repeated = np.maximum(1, words // np.maximum(self.wide, 1))
        lost[:] = np.maximum(0, n - bits // repeated)
        self.levels = [(rows, n, n, lost)]
        step = LEAF
        while len(self.levels[-1][0]) > 1:
            rows, low, high, lost = self.levels[-1]
            cut = np.arange(0, len(rows), step)
            self.levels.append((np.bitwise_or.reduceat(rows, cut, axis=0), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(lost, cut)))
            step = FAN_OUT
        self.steps = [1, LEAF, *[FAN_OUT] * (len(self.levels) - 2)]

    def children(self, level: int, entry: int) -> np.ndarray:
        step = self.steps[level]
        return np.arange(entry * step, min((entry + 1) * step, len(self.levels[level - 1][0])))


def _possible(a: tuple, i: np.ndarray, b: tuple, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of tree entries may hold a link: by size ranges, and by the
    largest overlap that their bitmaps allow."""
    rows_a, low_a, high_a, lost_a = a
    rows_b, low_b, high_b, lost_b = b
    ok = (100 * high_a[i] >= percent * low_b[j]) & (100 * high_b[j] >= percent * low_a[i])
    out = np.zeros(len(i), bool)
    at = np.flatnonzero(ok)
    many = max(1, COMPARED_WORDS // rows_a.shape[1])
    for lo in range(0, len(at), many):
        p = at[lo : lo + many]
        x, y = i[p], j[p]
        shared = np.bitwise_count(rows_a[x] & rows_b[y]).sum(axis=1).astype(np.int64)
        # Shared tokens set shared bits; those that fall together are lost ones.
        most = np.minimum(shared + np.minimum(lost_a[x], lost_b[y]), np.minimum(high_a[x], high_b[y]))
        out[p] = linked(most, low_a[x], low_b[y], percent)
    return out


def traverse(a: Tree, b: Tree, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (rows of a, rows of b) that may be linked: both trees are walked
    down together, dropping pairs of entries that cannot hold a link. With
    ``a is b`` each pair comes once."""
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    la, lb = len(a.levels) - 1, len(b.levels) - 1
    while True:
        keep = _possible(a.levels[la], i, b.levels[lb], j, percent)
        if a is b:
            keep &= i <= j if la else i < j
        i, j = i[keep], j[keep]
        if la == 0 and lb == 0:
            return a.order[i], b.order[j]
        down_a, down_b = la >= lb and la > 0, lb >= la and lb > 0
        pairs_i, pairs_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            cx = a.children(la, x) if down_a else np.array([x])
            cy = b.children(lb, y) if down_b else np.array([y])
            pairs_i.append(np.repeat(cx, len(cy)))
            pairs_j.append(np.tile(cy, len(cx)))
        i, j = np.concatenate(pairs_i), np.concatenate(pairs_j)
        la, lb = la - down_a, lb - down_b


def _column(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a sample of texts, sorted (a bounded list),
    and those of them whose nodes are too many for one task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch, limit=SLICE):
                sets = shingle_sets(*flat_bytes(batch.column("text").slice(lo, hi - lo)))
                every = np.concatenate([np.zeros(0, np.uint64), *sets])
                order = np.argsort(every % np.uint64(parts), kind="stable")
                every = every[order]
                ends = np.searchsorted(every % np.uint64(parts), np.arange(parts + 1, dtype=np.uint64))
                some = np.flatnonzero(np.diff(ends))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), _column([every[ends[k] : ends[k + 1]].tobytes() for k in some])], names=["bucket", "tokens"]
                )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        token, n = np.unique(np.frombuffer(b"".join(pdf["tokens"]), np.uint64), return_counts=True)
        many = n >= LEAST_COUNT
        return pd.DataFrame({"token": token[many].view(np.int64), "n": n[many].astype(np.int64)})

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = docs.filter(f"pmod(xxhash64(text), {SAMPLE_SHARE}) = 0").select("text")
    top = (
        sample.mapInArrow(count, "bucket long, tokens binary").groupBy("bucket").applyInPandas(add, "token long, n long")
        .orderBy(F.col("n").desc(), "token").limit(FREQUENT)
    )
    rows = top.collect()
    every = np.array([r.token for r in rows], np.int64).view(np.uint64)
    many = np.array([r.n >= HOT_COUNT for r in rows], bool)
    return np.sort(every), np.sort(every[many])


def prefix(shingles: np.ndarray, late: np.ndarray, percent: int = PERCENT, counts: np.ndarray | None = None) -> np.ndarray:
    """The first n - ceil(P n) + 1 shingles of a sorted set, the rarest by
    ``counts`` first and those of ``late`` after all others."""
    n = len(shingles)
    keep = n - least_overlap(n, percent) + 1
    if counts is not None:
        shingles = shingles[np.argsort(counts, kind="stable")]
    if len(late):
        at = np.minimum(np.searchsorted(late, shingles), len(late) - 1)
        is_late = late[at] == shingles
        shingles = np.concatenate([shingles[~is_late], shingles[is_late]])
    return shingles[:keep]


MEMBERS = "doc_id long, copy long, node binary, n long, marks binary"
ENTRIES = "bucket long, tokens binary, places binary, owners binary, nodes binary"
LAST_PLACE = (1 << 16) - 1  # places from here on count as this one, which drops fewer pairs


def sliced_sets(texts: pa.Array) -> list[np.ndarray]:
    """The shingle sets of many texts, hashed in slices: hashing takes several times
    the bytes of its texts."""
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    return [s for lo, hi in text_slices(batch, limit=SLICE) for s in shingle_sets(*flat_bytes(texts.slice(lo, hi - lo)))]


def fingerprints(sets: list[np.ndarray]) -> list[bytes | None]:
    """The node of each shingle set (none for an empty set)."""
    return [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]


def members(docs: DataFrame) -> DataFrame:
    """A row for each document: doc_id, copy, node, n (size of its set), marks."""
    kinds = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("node", pa.binary()), ("n", pa.int64()), ("marks", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch, limit=SLICE):
                part = batch.slice(lo, hi - lo)
                sets = shingle_sets(*flat_bytes(part.column("text")))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), "copy": part.column("copy"), "node": fingerprints(sets), "n": [len(s) for s in sets],
                     "marks": [signature(s) if len(s) else None for s in sets]}, schema=kinds)

    return docs.select("doc_id", "copy", "text").mapInArrow(make, MEMBERS)


def sliced_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, np.ndarray, list[np.ndarray]]]:
    """For each slice of texts its name (a hash of its nodes), its distinct nodes
    (fingerprint and size, 24 bytes each) and their shingle sets."""
    for batch in batches:
        for lo, hi in text_slices(batch, limit=SLICE):
            sets = shingle_sets(*flat_bytes(batch.column("text").slice(lo, hi - lo)))
            nodes = fingerprints(sets)
            first = {node: k for k, node in reversed(list(enumerate(nodes))) if node}
            every = sorted(first.values())
            for at in range(0, len(every), SLICE_NODES):
                rows = every[at : at + SLICE_NODES]
                ids = np.frombuffer(b"".join(nodes[k] for k in rows), np.uint8).reshape(-1, 16)
                ids = np.hstack([ids, np.array([len(sets[k]) for k in rows], "<u8").view(np.uint8).reshape(-1, 8)])
                yield hashlib.blake2b(ids.tobytes(), digest_size=16).digest(), ids, [sets[k] for k in rows]


def bucket_ranges(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order that puts equal buckets together, and (bucket, from, to) of each in it."""
    order = np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 1 << 16 else bucket, kind="stable")
    some, start = np.unique(bucket[order], return_index=True)
    return order, list(zip(some.tolist(), start.tolist(), np.append(start, len(order))[1:].tolist(), strict=True))


def node_sizes(ids: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(ids[:, 16:]).view("<u8").ravel().astype(np.int64)


def alone(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each row of a bucket the owners of those of its shingles that no other
    node has. Owners are packed as differences."""
    token = np.frombuffer(b"".join(pdf["tokens"]), "<u4")
    order = np.argsort(token)
    edge = np.r_[True, np.diff(token[order]) != 0, True]
    single = np.zeros(len(token), bool)
    single[order[edge[:-1] & edge[1:]]] = True
    own, lo = [], 0
    for packed in pdf["owners"]:
        owner = np.cumsum(np.frombuffer(packed, "<u2"), dtype=np.int64)
        own.append(np.diff(owner[single[lo : lo + len(owner)]], prepend=0).astype("<u2").tobytes())
        lo += len(owner)
    return pd.DataFrame({"slice": pdf["slice"], "nodes": pdf["nodes"], "owners": own})


def not_alone(pdf: pd.DataFrame, percent: int = PERCENT) -> pd.DataFrame:
    """The nodes of a slice that have too few shingles of their own to be without
    a link."""
    ids = np.frombuffer(next(x for x in pdf["nodes"] if x is not None), np.uint8).reshape(-1, 24)
    own = np.zeros(len(ids), np.int64)
    for packed in pdf["owners"]:
        own += np.bincount(np.cumsum(np.frombuffer(packed, "<u2"), dtype=np.int64), minlength=len(ids))
    n = node_sizes(ids)
    return pd.DataFrame({"node": [x.tobytes() for x in ids[own <= n - least_overlap(n, percent), :16]]})


def shared_nodes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every node that may have a link, in rows (node) that may repeat: nodes of
    which n - ceil(P n) + 1 shingles stand in no other text are left out. Shingles
    go to buckets by hash, four bytes of each, at most twice from a slice; what
    falls together is not taken to be alone."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = pa.schema([("bucket", pa.int64()), ("slice", pa.binary()), ("nodes", pa.binary()), ("tokens", pa.binary()), ("owners", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, sets in sliced_nodes(batches):
            token = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            order = np.argsort(token, kind="stable")
            third = np.r_[np.zeros(min(2, len(token)), bool), token[order][2:] == token[order][:-2]]
            few = np.sort(order[~third])
            token, owner = token[few], owner[few]
            order, ranges = bucket_ranges((token >> np.uint64(8)) % np.uint64(parts))
            token, owner = (token[order] >> np.uint64(32)).astype("<u4"), owner[order]
            carrier = int.from_bytes(name[:4], "little") % len(ranges)
            yield pa.RecordBatch.from_pydict(
                {"bucket": [b for b, _, _ in ranges], "slice": [name] * len(ranges),
                 "nodes": [ids.tobytes() if k == carrier else None for k in range(len(ranges))],
                 "tokens": [token[lo:hi].tobytes() for _, lo, hi in ranges],
                 "owners": [np.diff(owner[lo:hi], prepend=0).astype("<u2").tobytes() for _, lo, hi in ranges]}, schema=kinds)

    return (
        docs.select("text").mapInArrow(make, "bucket long, slice binary, nodes binary, tokens binary, owners binary")
        .groupBy("bucket").applyInPandas(alone, "slice binary, nodes binary, owners binary")
        .groupBy("slice").applyInPandas(lambda pdf: not_alone(pdf, percent), "node binary")
    )


def counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each row of a bucket how many nodes have each of its shingles."""
    token, held = (np.frombuffer(b"".join(pdf[c]), kind) for c, kind in (("tokens", np.uint64), ("held", "<u4")))
    _, of = np.unique(token, return_inverse=True)
    every = np.bincount(of, weights=held)[of].astype("<u4")
    ends = np.cumsum([len(x) // 8 for x in pdf["tokens"]]).tolist()
    return pdf.drop(columns=["bucket", "held"]).assign(counts=[every[lo:hi].tobytes() for lo, hi in zip([0, *ends], ends, strict=False)])


def entries(docs: DataFrame, late: np.ndarray, percent: int = PERCENT, hot: np.ndarray | None = None) -> DataFrame:
    """For each slice of texts and bucket a row with its prefix shingles (tokens,
    their places in the order of their sets, owners: numbers in nodes, and nodes:
    fingerprint and size of 24 bytes each). Those that one node only has are left
    out, as nothing meets there.
    The order needs the nodes of every shingle: slices send their shingles to
    buckets, which send counts back to the slice, whose sets go along.
    Nodes of ``hot`` shingles are dealt to further buckets, from the number of
    partitions on. The rows go straight to the tasks of their buckets: a table
    of them would hold as much again on disk."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = pa.schema([("bucket", pa.int64()), *((c, pa.binary()) for c in ("slice", "nodes", "sets", "tokens", "held"))])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, sets in sliced_nodes(batches):
            every = np.concatenate(sets)
            token, held = np.unique(every, return_counts=True)
            order, ranges = bucket_ranges((token >> np.uint64(8)) % np.uint64(parts))
            token, held = token[order], held[order].astype("<u4")
            carrier = int.from_bytes(name[:4], "little") % len(ranges)
            carried = [k == carrier for k in range(len(ranges))]
            yield pa.RecordBatch.from_pydict(
                {"bucket": [b for b, _, _ in ranges], "slice": [name] * len(ranges),
                 "nodes": [ids.tobytes() if x else None for x in carried], "sets": [every.tobytes() if x else None for x in carried],
                 "tokens": [token[lo:hi].tobytes() for _, lo, hi in ranges],
                 "held": [held[lo:hi].tobytes() for _, lo, hi in ranges]}, schema=kinds)

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        shared, dealt = late_list.value
        whole = pdf[pdf["nodes"].notna()].iloc[0]  # slices of the same nodes have one name
        ids, every = np.frombuffer(whole["nodes"], np.uint8).reshape(-1, 24), np.frombuffer(whole["sets"], np.uint64)
        known, count = (np.frombuffer(b"".join(pdf[c]), kind) for c, kind in (("tokens", np.uint64), ("counts", "<u4")))
        order = np.argsort(known)
        known, count = known[order], count[order]
        count_of = lambda x: count[np.searchsorted(known, x)]
        ends = np.cumsum(node_sizes(ids)).tolist()
        heads = [prefix(every[lo:hi], shared, percent, count_of(every[lo:hi])) for lo, hi in zip([0, *ends], ends, strict=False)]
        token = np.concatenate(heads)
        place = np.concatenate([np.minimum(np.arange(len(h)), LAST_PLACE).astype("<u2") for h in heads])
        owner = np.repeat(np.arange(len(heads), dtype=np.uint32), [len(h) for h in heads])
        met = np.flatnonzero(count_of(token) > 1)
        token, place, owner = token[met], place[met], owner[met]
        bucket = (token >> np.uint64(8)) % np.uint64(parts)
        salt = ids[owner, 0].astype(np.uint64) % np.uint64(HOT_PARTS)
        bucket += np.where(np.isin(token, dealt), np.uint64(parts) * (salt + np.uint64(1)), np.uint64(0))
        order, ranges = bucket_ranges(bucket)
        token, owner, place = token[order], owner[order], place[order]
        out = {"bucket": [b for b, _, _ in ranges], "tokens": [], "places": [], "owners": [], "nodes": []}
        for _, lo, hi in ranges:
            own, of = np.unique(owner[lo:hi], return_inverse=True)
            out["tokens"].append(token[lo:hi].tobytes())
            out["places"].append(place[lo:hi].tobytes())
            out["owners"].append(of.astype("<u4").tobytes())
            out["nodes"].append(ids[own].tobytes())
        return pd.DataFrame(out)

    # Bounded by FREQUENT.
    late_list = docs.sparkSession.sparkContext.broadcast((late, np.zeros(0, np.uint64) if hot is None else hot))
    return (
        docs.select("text").mapInArrow(make, "bucket long, slice binary, nodes binary, sets binary, tokens binary, held binary")
        .groupBy("bucket").applyInPandas(counted, "slice binary, nodes binary, sets binary, tokens binary, counts binary")
        .groupBy("slice").applyInPandas(deal, ENTRIES)
    )


def meet(pdf: pd.DataFrame, percent: int = PERCENT, dealt: bool = False) -> pd.DataFrame:
    """Nodes of a bucket that share a prefix shingle: pairs (a, b) of small
    groups whose sizes and places allow a link (the first shingle that two sets
    share leaves them no more to share than what follows it in each), and for large groups edges (a, b) that
    connect all groups with a node in common (column large). In a bucket of
    shingles whose nodes are ``dealt``, all groups are large and have an edge to
    their shingle, a name of 8 bytes."""
    token, place = np.frombuffer(b"".join(pdf["tokens"]), np.uint64), np.frombuffer(b"".join(pdf["places"]), "<u2")
    nodes = np.frombuffer(b"".join(pdf["nodes"]), np.uint8).reshape(-1, 24)
    counts = np.array([len(x) // 24 for x in pdf["nodes"]])
    base = np.cumsum(counts) - counts
    owner = np.concatenate([np.frombuffer(x, "<u4").astype(np.int64) + b for x, b in zip(pdf["owners"], base, strict=True)])
    # One number for each distinct node of the bucket.
    whole = np.ascontiguousarray(nodes[:, :16]).view("V16").ravel()
    halves = np.ascontiguousarray(nodes[:, :16]).view("<u8").reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.r_[True, (np.diff(halves[order], axis=0) != 0).any(axis=1)]
    number = np.empty(len(nodes), np.int64)
    number[order] = np.cumsum(new) - 1
    names, size = whole[order][new], np.ascontiguousarray(nodes[:, 16:]).view("<u8").ravel().astype(np.int64)[order][new]
    owner = number[owner]
    order = np.lexsort((owner, token))
    token, owner, place = token[order], owner[order], place[order]
    once = np.r_[True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])]
    token, owner = token[once], owner[once]
    most = size[owner] - place[once]  # shingles of the owner's set from this one on
    start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    length = np.diff(np.r_[start, len(token)])
    pairs = [np.zeros((0, 2), np.int64)]
    least = 0 if dealt else LEAF
    for m in range(2, least + 1):
        every = start[length == m]
        x, y = np.triu_indices(m, 1)
        step = max(1, MET_PAIRS // len(x))
        for at in (every[k : k + step] for k in range(0, len(every), step)):
            spots = at[:, None] + np.arange(m)
            left, right = spots[:, x].ravel(), spots[:, y].ravel()
            keep = linked(np.minimum(most[left], most[right]), size[owner[left]], size[owner[right]], percent)
            pairs.append(np.unique(np.stack([owner[left[keep]], owner[right[keep]]], axis=1), axis=0))
    small = np.unique(np.concatenate(pairs), axis=0)
    # Large groups: the least member of each connected set of groups.
    root = np.arange(len(names))
    groups = [owner[s : s + n] for s, n in zip(start[length > least], length[length > least], strict=True)]
    changed = True
    while changed:
        changed = False
        for g in groups:
            first = root[g].min()
            if (root[g] != first).any():
                root[g], changed = first, True
    members = np.unique(np.concatenate([np.zeros(0, np.int64), *groups]))
    large = np.stack([members, root[members]], axis=1)
    both = np.concatenate([small, large])
    ends = [[x.tobytes() for x in names[both[:, k]]] for k in (0, 1)]
    if dealt:
        ends[0] += [x.tobytes() for x in token[start]]
        ends[1] += [x.tobytes() for x in names[owner[start]]]
    return pd.DataFrame({"a": ends[0], "b": ends[1], "large": np.arange(len(ends[0])) >= len(small)})


def block_links(pdf: pd.DataFrame, percent: int = PERCENT) -> pd.DataFrame:
    """Links that connect the linked texts of the two blocks of each task row
    set (family, i, j), from the traversal of their signature trees."""
    out: list[tuple[bytes, bytes]] = []
    for (_, i, j), own in pdf.groupby(["family", "i", "j"], sort=False):
        own = own.sort_values("node", ignore_index=True)
        sets = sliced_sets(pa.array(own["text"], pa.large_string()))
        sizes, marks = np.array([len(s) for s in sets]), [signature(s, DENSE) for s in sets]
        words = min(TREE_WORDS, max(map(len, marks)) // 8)
        sides = [np.flatnonzero(own["part"].to_numpy() == k) for k in (i, j)]
        trees = [Tree(sizes[at], [marks[k] for k in at], words) for at in (sides[:1] if i == j else sides)]
        x, y = traverse(trees[0], trees[-1], percent)
        root = list(range(len(sets)))

        def find(k: int, root: list[int] = root) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        names = own["node"].tolist()
        for a, b in zip(sides[0][x].tolist(), sides[-1][y].tolist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb and linked(len(np.intersect1d(sets[a], sets[b], assume_unique=True)), len(sets[a]), len(sets[b]), percent):
                root[max(ra, rb)] = min(ra, rb)
                out.append((min(names[a], names[b]), max(names[a], names[b])))
    return pd.DataFrame({"a": [p[0] for p in out], "b": [p[1] for p in out]})


def leaf_test(pdf: pd.DataFrame, percent: int = PERCENT) -> np.ndarray:
    """Which rows (n_a, marks_a, n_b, marks_b) may be linked by their bitmaps."""
    keep = np.zeros(len(pdf), bool)
    wide = np.minimum(pdf["marks_a"].str.len(), pdf["marks_b"].str.len()).to_numpy() // 8
    for words in np.unique(wide):
        at = np.flatnonzero(wide == words)
        n = [pdf[c].to_numpy()[at].astype(np.int64) for c in ("n_a", "n_b")]
        rows = [np.vstack([fold(np.frombuffer(m, np.uint64)[None, :], words) for m in pdf[c].to_numpy()[at]]) for c in ("marks_a", "marks_b")]
        lost = [np.maximum(0, k - np.bitwise_count(r).sum(axis=1).astype(np.int64)) for k, r in zip(n, rows, strict=True)]
        shared = np.bitwise_count(rows[0] & rows[1]).sum(axis=1).astype(np.int64)
        keep[at] = linked(np.minimum(shared + np.minimum(*lost), np.minimum(*n)), n[0], n[1], percent)
    return keep


def small_pairs(met: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b), a < b, of small groups that sizes and bitmaps allow."""

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.loc[leaf_test(pdf, percent), ["a", "b"]]

    sides = [nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("marks").alias(f"marks_{s}")) for s in "ab"]
    return (
        met.filter("NOT large").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        .join(sides[0], "a").join(sides[1], "b").mapInPandas(test, "a binary, b binary")
    )


def family_links(families: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) inside families (node, family), which connect all that are
    linked. Every group that meets in a task is a block, or two.

    Nodes are dealt into blocks by hash, and those of more than one block once
    more by another hash, and linked inside each block. Then every component of
    a block's size or more has blocks of its own, and all pairs of blocks of a
    family meet but those of one component, which are connected already."""

    def linked_in(rows: DataFrame) -> DataFrame:
        return written(
            rows.groupBy("family", "i", "j").applyInPandas(lambda pdf: block_links(pdf, percent), "a binary, b binary"), "jaccard-blocks"
        )

    nodes = written(families.join(texts.select("node"), "node"), "jaccard-family-nodes")
    counts = nodes.groupBy("family").agg(F.expr(f"CAST(ceil(count(1) / {BLOCK}) AS long)").alias("blocks"))
    dealt = (
        nodes.join(counts, "family").withColumn("deal", F.expr("explode(sequence(0L, CAST(blocks > 1 AS long)))"))
        .selectExpr("node", "family", "pmod(xxhash64(node, deal), blocks) + deal * blocks AS part")
    )
    inside = linked_in(dealt.join(texts, "node").selectExpr("family", "node", "text", "part", "part AS i", "part AS j"))
    wide = nodes.join(counts.filter("blocks > 1"), "family").select("node", "family")
    if wide.isEmpty():
        return inside
    rooted = wide.join(components(inside).withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").selectExpr(
        "node", "family", "coalesce(root, node) AS root"
    )
    sizes = rooted.groupBy("root").agg(F.count("*").alias("n")).withColumnRenamed("root", "_root").filter(f"n >= {BLOCK}")
    # Components below the size of a block share blocks (own is null).
    own = rooted.join(sizes, F.col("root") == F.col("_root"), "left").selectExpr("node", "family", "_root AS own")
    shares = own.groupBy("family", "own").agg(F.expr(f"CAST(ceil(count(1) / {BLOCK}) AS long)").alias("shares"))
    shares = shares.selectExpr("family AS _family", "own AS _own", "shares")
    numbered = own.join(shares, F.expr("family = _family AND own <=> _own")).selectExpr("node", "family", "own", "xxhash64(own, pmod(xxhash64(node, 2), shares)) AS part")
    numbered = written(numbered, "jaccard-family-blocks")
    blocks = numbered.select("family", "own", "part").distinct()
    pairs = blocks.alias("x").join(blocks.alias("y"), F.expr("x.family = y.family AND x.part <= y.part AND (x.own IS NULL OR y.own IS NULL OR x.own <> y.own)"))
    pairs = written(pairs.selectExpr("x.family AS _family", "x.part AS i", "y.part AS j"), "jaccard-block-pairs")
    sides = pairs.selectExpr("_family", "i", "j", "explode(array_distinct(array(i, j))) AS _part")
    across = numbered.join(sides, F.expr("family = _family AND part = _part")).join(texts, "node")
    return inside.unionByName(linked_in(across.select("family", "node", "text", "part", "i", "j")))


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose texts are linked, by their whole shingle sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch, "text_a", SLICE // 4):
                part = batch.slice(lo, hi - lo)
                left, right = (shingle_sets(*flat_bytes(part.column(c))) for c in ("text_a", "text_b"))
                keep = [bool(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent)) for x, y in zip(left, right, strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(keep))

    sides = [texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "text_a", "text_b").mapInArrow(compare, "a binary, b binary")


def node_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text for each wanted node (node, doc_id, copy): texts are looked up by
    id and hash and checked against the fingerprint, as both may repeat."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch, limit=SLICE):
                part = batch.slice(lo, hi - lo)
                sets = shingle_sets(*flat_bytes(part.column("text")))
                keep = [own == n for own, n in zip(fingerprints(sets), part.column("node").to_pylist(), strict=True)]
                yield part.filter(pa.array(keep))

    own = docs.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), "text")
    found = wanted.join(own, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy"))).select("node", "text").mapInArrow(check, "node binary, text string")
    return found.dropDuplicates(["node"])


def links(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(a row for each document: doc_id, copy (hash of the text), node, n; edges
    a, b that connect the linked nodes). Nodes are fingerprints of shingle sets."""
    docs = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS copy")
    late, hot = frequent(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = written(members(docs), "jaccard-members")
    some = written(shared_nodes(docs, percent), "jaccard-shared").distinct()
    nodes = (
        own.join(some, "node", "left_semi").groupBy("node")
        .agg(F.first("n").alias("n"), F.first("marks").alias("marks"), F.min(F.struct("doc_id", "copy")).alias("k"))
    )
    nodes = written(nodes.select("node", "n", "marks", "k.doc_id", "k.copy"), "jaccard-nodes")
    texts = written(node_texts(docs, nodes.select("node", "doc_id", "copy")), "jaccard-texts")
    met = written(
        entries(texts, late, percent, hot).groupBy("bucket")
        .applyInPandas(lambda pdf: meet(pdf, percent, pdf["bucket"].iloc[0] >= parts), "a binary, b binary, large boolean"),
        "jaccard-met",
    )
    pairs = written(small_pairs(met, nodes.select("node", "n", "marks"), percent), "jaccard-pairs")
    families = written(components(met.filter("large").select("a", "b")).select("node", F.col("root").alias("family")), "jaccard-families")
    # One partner for each node first; most other pairs are then connected.
    nearest = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    first = written(verified(nearest, texts, percent).unionByName(family_links(families, texts, percent)), "jaccard-links")
    roots = written(components(first), "jaccard-roots")
    apart = (
        pairs.join(roots.selectExpr("node AS a", "root AS root_a"), "a", "left").join(roots.selectExpr("node AS b", "root AS root_b"), "b", "left")
        .filter("coalesce(root_a, a) <> coalesce(root_b, b)").select("a", "b")
    )
    second = written(verified(apart, texts, percent), "jaccard-links")
    return own.select("doc_id", "copy", "node", "n"), roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(second)


def rooted(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``links`` with the root node of their class."""
    own, edges = links(docs, percent)
    roots = components(edges).withColumnRenamed("node", "_node")
    return own.join(roots, F.col("node") == F.col("_node"), "left").select("doc_id", "copy", "n", F.coalesce("root", "node").alias("root"))


def classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text; other columns are
    ignored): doc_id, n_shingles, component_id, the least doc_id reachable by
    links.

    Null and empty texts, and texts of white space, have no shingles and no
    links: their component is their own doc_id. Texts with equal shingle sets
    are linked. Rows may repeat; a row with a null doc_id takes part, and its
    component is the least id of its class that is not null, if there is one.
    """
    own = written(rooted(docs, percent), "jaccard-classes")
    least = own.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least")).withColumnRenamed("root", "_root")
    return own.join(least, F.col("root") == F.col("_root"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.expr("CASE WHEN root IS NULL THEN doc_id ELSE least END").alias("component_id")
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each class: that of the least doc_id (null ids
    last, then by a hash of the text). Rows without shingles all stay."""
    own = rooted(docs, percent)
    keep = own.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("blank"), "doc_id", "copy")).alias("k"))
    keep = written(
        keep.selectExpr("k.doc_id AS _id", "k.copy AS _copy", "true AS _one")
        .unionByName(own.filter("root IS NULL").selectExpr("doc_id AS _id", "copy AS _copy", "false AS _one")).distinct(),
        "jaccard-kept",
    )
    names = docs.columns
    rows = docs.withColumn("_own", F.expr("xxhash64(coalesce(text, ''))")).join(
        keep, F.expr("CAST(doc_id AS long) <=> _id AND _own = _copy")
    )
    once = rows.filter("_one").dropDuplicates(["_id", "_copy"])
    return rows.filter("NOT _one").unionByName(once).select(*names)
