"""Repeated byte strings across and within documents, and their removal.

Finding every place where a string of ``width`` bytes occurs that also starts
elsewhere, in four steps:

1. Every ``width``-byte window of a text is assigned to an anchor, the smallest
   hashed ``GRAM``-byte string inside it (leftmost of ties). Equal windows have
   equal anchors at equal offsets. Neighbouring windows with the same anchor
   form one context: a row (anchor hash, context hash, place).
2. Anchors that occur once are gone after one count. Contexts with the same
   anchor and content occur at several places, so all their bytes repeat.
3. What is left are contexts that are alone under an anchor with others. Their
   bytes, and one copy of each other context of the anchor, meet in a task: an
   enhanced suffix array (suffixes, common-prefix lengths), scanned with a
   stack for its intervals of common prefixes; the intervals whose occurrences
   have different left neighbours are the maximal repeats, and they list all
   their occurrences.
4. An anchor with very many different contexts is not gathered: the windows of
   those contexts are counted by hash over all tasks instead, to the same end.

Documents with the same text share one key (hash and length of the text).
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
from ledgerlens.llm.rolling import Rolling

WIDTH = 200
GRAM = 32
CHUNK = 1 << 18  # window starts handled at a time
GATHERED = 4000  # contexts of one anchor that are gathered in a task; beyond, step 4
BUCKET_BYTES = 500_000  # context bytes aimed at for one suffix array


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """Least value of every ``size`` neighbours, in linear time."""
    n = len(values) - size + 1
    top = np.iinfo(np.uint64).max
    blocks = np.concatenate([values, np.full(-len(values) % size, top, np.uint64)]).reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[size - 1 : size - 1 + n])


def contexts(raw: np.ndarray, bounds: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, context hash, text number, start in the text, bytes) arrays
    of the contexts of all windows of the texts."""
    low = np.uint64((1 << 21) - 1)
    for c0 in range(0, max(0, len(raw) - width + 1), CHUNK):
        part = raw[c0 : c0 + CHUNK + width - 1]
        rolling = Rolling(part)
        grams = rolling.every(gram)
        order = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        at = (sliding_least(order, width - gram + 1) & low).astype(np.int64)
        start = np.arange(c0, c0 + len(at))
        of = np.searchsorted(bounds, start, side="right") - 1
        ok = np.flatnonzero(start + width <= bounds[of + 1])
        if not len(ok):
            continue
        new = np.r_[True, (np.diff(ok) > 1) | (np.diff(at[ok]) != 0)]
        first = ok[new]
        last = ok[np.r_[np.flatnonzero(new)[1:] - 1, len(ok) - 1]]
        end = last + width
        yield grams[at[first]], rolling.some(first, end), of[first], first + c0 - bounds[of[first]], end - first


def suffix_array(data: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of several texts laid end to end, sorted, and the common prefix
    of each with the one before it (0 for the first).

    ``rest`` is how many bytes of its text each position still has; suffixes
    end with their text. Ranks of prefixes double in length, and only suffixes
    whose rank is shared are sorted again; the ranks of all lengths give the
    common prefixes."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n)
    key = np.zeros(n, np.int64)
    for k in range(7):  # seven bytes (1 .. 256, 0 past the end) in base 257
        symbol = np.zeros(n, np.int64)
        there = rest > k
        symbol[there] = data[at[there] + k].astype(np.int64) + 1
        key = key * 257 + symbol
    sa = np.argsort(key, kind="stable")
    new = np.r_[True, np.diff(key[sa]) != 0]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, at, 0)) + 1  # 0 stands for the end
    levels, size = [(7, rank.astype(np.int32))], 7  # a bucket is far below 2^31 bytes
    while size < int(rest.max()):
        shared = np.flatnonzero(~new | np.r_[~new[1:], False])
        if not len(shared):
            break
        pos = sa[shared]
        after = np.zeros(len(pos), np.int64)
        there = rest[pos] > size
        after[there] = rank[pos[there] + size]
        both = rank[pos] * (n + 2) + after
        order = np.argsort(both, kind="stable")
        sa[shared], both = pos[order], both[order]
        first = np.r_[True, np.diff(both) != 0]
        new = new.copy()
        new[shared] = first
        lead = np.maximum.accumulate(np.where(new, at, 0))
        changed = rank.copy()
        changed[sa] = lead + 1
        if (changed == rank).all() and (first == np.r_[True, np.diff(rank[sa[shared]]) != 0]).all():
            levels.append((size * 2, changed.astype(np.int32)))
            size *= 2
            continue
        rank = changed
        size *= 2
        levels.append((size, rank.astype(np.int32)))
    lcp = np.zeros(n, np.int64)
    a, b = sa[1:], sa[:-1]
    most = np.minimum(rest[a], rest[b])
    common = np.zeros(n - 1, np.int64)
    for size, ranks in reversed(levels):
        inside = common < most
        same = np.zeros(n - 1, bool)
        same[inside] = ranks[a[inside] + common[inside]] == ranks[b[inside] + common[inside]]
        common[same] += size
    common = np.minimum(common, most)
    for k in range(6):  # the last bytes below one key
        open_ = common < most
        same = np.zeros(n - 1, bool)
        same[open_] = data[a[open_] + common[open_]] == data[b[open_] + common[open_]]
        common[same] += 1
    lcp[1:] = common
    return sa, lcp


def maximal_repeats(data: np.ndarray, bounds: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, starts of all occurrences) of every maximal repeat of ``least``
    bytes or more in texts laid end to end: strings with two occurrences or
    more that no longer string has, to the right (intervals of the suffix
    array) or to the left (different bytes before them; the start of a text
    differs from anything)."""
    size = np.diff(bounds)
    rest = np.repeat(bounds[1:], size) - np.arange(len(data))
    sa, lcp = suffix_array(data, rest)
    before = np.zeros(len(data), np.int64)
    before[1:] = data[:-1]
    starts = bounds[:-1][size > 0]
    before[starts] = -1 - np.arange(len(starts))
    left = before[sa]
    varied = np.concatenate([[0], np.cumsum(np.r_[0, (left[1:] != left[:-1]).astype(np.int64)])])  # changes up to each entry
    stack: list[tuple[int, int]] = []  # (common prefix, first entry) of the open intervals
    entries = np.flatnonzero(lcp >= least)
    ends = np.flatnonzero(np.r_[np.diff(entries) > 1, True]) if len(entries) else []
    first = 0
    for e in ends:
        run = entries[first : e + 1]
        first = e + 1
        for i, height in zip(run.tolist() + [int(run[-1]) + 1], lcp[run].tolist() + [0], strict=True):
            begin = i - 1
            while stack and stack[-1][0] > height:
                depth, begin = stack.pop()
                # entries begin .. i - 1 share depth bytes
                if varied[i] - varied[begin + 1] > 0:
                    yield depth, sa[begin:i]
            if height >= least and (not stack or stack[-1][0] < height):
                stack.append((height, begin))
        stack.clear()


def repeated_parts(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
    """Repeated ranges (key, size, start, stop) of the contexts of a bucket
    that stand alone (column n is 1), from a suffix array over all of them."""
    blobs = pdf["data"].tolist()
    data = np.frombuffer(b"".join(blobs), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).astype(np.int64)
    cover = np.zeros(len(data) + 1, np.int64)
    for depth, at in maximal_repeats(data, bounds, width):
        np.add.at(cover, at, 1)
        np.add.at(cover, at + depth, -1)
    # A repeat may end with its context, never beyond it: count each by itself.
    inside = np.cumsum(cover[:-1]) > 0
    of = np.repeat(np.arange(len(blobs)), np.diff(bounds))
    marked = np.flatnonzero(inside & (pdf["n"].to_numpy() == 1)[of])
    if not len(marked):
        return pd.DataFrame({"key": [], "size": [], "start": [], "stop": []}).astype("int64")
    new = np.r_[True, (np.diff(marked) > 1) | (np.diff(of[marked]) != 0)]
    lo, hi = marked[new], marked[np.r_[np.flatnonzero(new)[1:] - 1, len(marked) - 1]] + 1
    row = of[lo]
    shift = pdf["start"].to_numpy()[row] - bounds[row]
    return pd.DataFrame({"key": pdf["key"].to_numpy()[row], "size": pdf["size"].to_numpy()[row], "start": lo + shift, "stop": hi + shift})


def keyed(docs: DataFrame) -> DataFrame:
    """Texts with their keys; a null text is empty."""
    return docs.selectExpr("coalesce(text, '') AS text").selectExpr("text", "xxhash64(text) AS key", "CAST(octet_length(text) AS long) AS size")


def repeated_ranges(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Ranges of bytes (key, size, start, stop) of the distinct texts of
    ``docs`` that are covered by repeated ``width``-byte strings; they may
    overlap, and together cover all such bytes and no other."""
    spark = docs.sparkSession
    texts = keyed(docs).filter(f"size >= {width}")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = flat_bytes(batch.column("text"))
            keys, sizes = (np.asarray(batch.column(c)) for c in ("key", "size"))
            for anchor, context, of, start, length in contexts(raw, bounds, width, gram):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (anchor.view(np.int64), context.view(np.int64), keys[of], sizes[of], start, length)],
                    names=["anchor", "context", "key", "size", "start", "length"],
                )

    places = texts.mapInArrow(anchors, "anchor long, context long, key long, size long, start long, length long")
    # Written, so that the join below deals both sides by itself and can split a crowded anchor.
    several = written(places.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "repeat-anchors")
    shared = written(places.join(several, "anchor", "left_semi"), "repeat-places")

    # Contexts by content; one place stands for each.
    by_content = written(
        shared.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("key", "size", "start", "length")).alias("one")), "repeat-contexts"
    )
    whole = shared.join(by_content.filter("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi").selectExpr(
        "key", "size", "start", "start + length AS stop"
    )
    mixed = by_content.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("alone")).filter("kinds > 1 AND alone > 0")
    wanted = by_content.join(mixed, "anchor").selectExpr("anchor", "kinds", "n", "one.key", "one.size", "one.start", "one.length")
    per_text = wanted.groupBy("key", "size").agg(F.collect_list(F.struct("anchor", "kinds", "n", "start", "length")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: tuple | None = None
        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch.column("key")[i].as_py(), batch.column("size")[i].as_py())
                if key == done:  # another copy of the same text
                    continue
                done = key
                raw = batch.column("text")[i].as_py().encode()
                rows = [r for r in batch.column("wanted")[i].as_py()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": pa.array([r["anchor"] for r in rows], pa.int64()),
                        "kinds": pa.array([r["kinds"] for r in rows], pa.int64()),
                        "n": pa.array([r["n"] for r in rows], pa.int64()),
                        "key": pa.array([key[0]] * len(rows), pa.int64()),
                        "size": pa.array([key[1]] * len(rows), pa.int64()),
                        "start": pa.array([r["start"] for r in rows], pa.int64()),
                        "data": pa.array([raw[r["start"] : r["start"] + r["length"]] for r in rows], pa.binary()),
                    }
                )

    blobs = written(
        texts.join(per_text, ["key", "size"]).mapInArrow(cut, "anchor long, kinds long, n long, key long, size long, start long, data binary")
        # copies of a text that came apart in the join count once
        .dropDuplicates(["anchor", "key", "size", "start"]),
        "repeat-bytes",
    )
    total = blobs.filter(f"kinds <= {GATHERED}").selectExpr("sum(octet_length(data)) AS b").first()["b"] or 0
    buckets = max(1, -(-int(total) // BUCKET_BYTES))

    def gathered(pdf: pd.DataFrame) -> pd.DataFrame:
        return repeated_parts(pdf, width)

    alone = (
        blobs.filter(f"kinds <= {GATHERED}")
        .withColumn("bucket", F.expr(f"pmod(xxhash64(anchor), {buckets})"))
        .groupBy("bucket")
        .applyInPandas(gathered, "key long, size long, start long, stop long")
    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = np.frombuffer(batch.column("data")[i].as_py(), np.uint8)
                hashes = Rolling(raw).every(width).view(np.int64)
                m = len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes), *(pa.array(np.full(m, batch.column(c)[i].as_py(), np.int64)) for c in ("n", "key", "size")),
                     pa.array(np.arange(m, dtype=np.int64) + batch.column("start")[i].as_py())],
                    names=["hash", "n", "key", "size", "start"],
                )

    many = blobs.filter(f"kinds > {GATHERED}").mapInArrow(windows, "hash long, n long, key long, size long, start long")
    twice = many.groupBy("hash").agg(F.count("*").alias("m")).filter("m > 1").select("hash")
    counted = many.filter("n = 1").join(twice, "hash", "left_semi").selectExpr("key", "size", "start", f"start + {width} AS stop")
    return written(whole.unionByName(alone).unionByName(counted), "repeat-ranges").distinct()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def with_ranges(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with a column ``_spans``: the repeated ranges of each text."""
    ranges = repeated_ranges(docs, width, gram).groupBy("key", "size").agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))
    ranges = ranges.withColumnsRenamed({"key": "_key", "size": "_size"})
    own = docs.withColumn("_key", F.expr("xxhash64(coalesce(text, ''))")).withColumn("_size", F.expr("CAST(octet_length(coalesce(text, '')) AS long)"))
    return own.join(ranges, ["_key", "_size"], "left").drop("_key", "_size")


def _kept(raw: bytes, spans: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    cut = merged([(s["start"], s["stop"]) for s in spans or []])
    parts, at = [], 0
    for a, b in cut:
        parts.append(raw[at:a])
        at = b
    parts.append(raw[at:])
    return b"".join(parts), cut


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def report(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """What the removal takes from every document: doc_id, n_bytes, n_removed,
    n_spans (maximal removed runs), kept_sha256.

    A null text is empty; texts shorter than ``width`` lose nothing; exact
    copies of ``width`` bytes or more lose everything; repeated rows are
    documents of their own; a null doc_id stays null; other columns are
    ignored."""

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch):
                part, rows = batch.slice(lo, hi - lo), []
                for doc, text, spans in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "_spans")), strict=True):
                    raw = (text or "").encode()
                    kept, cut = _kept(raw, spans)
                    rows.append((doc, len(raw), len(raw) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    own = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text")
    return with_ranges(own, width, gram).select("doc_id", "text", "_spans").mapInArrow(sum_up, REPORT)


def remove(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``docs`` without the repeated bytes of their texts. Bytes of a character
    that is cut in two are dropped; n_chars, if there, follows; all rows and
    columns stay; untouched texts stay as they are (null too)."""
    names = docs.columns
    found = with_ranges(docs, width, gram).select(*names, "_spans")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch):
                part, out = batch.slice(lo, hi - lo), []
                for text, spans in zip(part.column("text").to_pylist(), part.column("_spans").to_pylist(), strict=True):
                    out.append(_kept(text.encode(), spans)[0].decode("utf-8", "ignore") if spans else text)
                columns = {n: part.column(n) for n in names}
                columns["text"] = pa.array(out, pa.string())
                if "n_chars" in columns:
                    columns["n_chars"] = pa.array([None if t is None else len(t) for t in out], pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

    if "n_chars" in names:
        found = found.withColumn("n_chars", F.col("n_chars").cast("long"))
    return found.mapInArrow(clean, found.drop("_spans").schema)
