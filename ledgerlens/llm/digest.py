"""Document fingerprints: quartile bucket digests.

Hashed byte triplets of a text (three spacings) are counted in buckets; each
bucket is encoded by the quartile of the counts it falls in, next to the text's
length on a logarithmic scale, two quartile ratios and a checksum. Two digests
are compared by a bounded difference score.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import flat_bytes, text_slices, written

BUCKETS = 256
# Second and third byte of a triplet. Wide spacings depend on the text at hand
# more than on the language's usual letter groups.
SPACINGS = ((1, 2), (3, 7), (5, 11))
STEP = 1 << 18  # positions counted at a time
BYTES = 4 + BUCKETS // 4  # checksum, length, two ratios, two bits a bucket
LENGTH_WEIGHT, RATIO_WEIGHT = 2, 4
LARGEST = 400.0  # difference from which on the likeness is 0


def bucket_counts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Triplets in each bucket, a row for each text."""
    n = len(bounds) - 1
    counts = np.zeros(n * BUCKETS, np.int64)
    for k, (second, third) in enumerate(SPACINGS):
        for lo in range(0, len(raw) - third, STEP):
            hi = min(lo + STEP, len(raw) - third)
            at = np.arange(lo, hi)
            of = np.searchsorted(bounds, at, side="right") - 1
            inside = at + third < bounds[of + 1]
            mixed = (
                raw[lo:hi].astype(np.uint32)
                | (raw[lo + second : hi + second].astype(np.uint32) << np.uint32(8))
                | (raw[lo + third : hi + third].astype(np.uint32) << np.uint32(16))
            ) + np.uint32(k << 24)
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            mixed = (mixed ^ (mixed >> np.uint32(12))) * np.uint32(0x297A2D39)
            bucket = (mixed >> np.uint32(24)).astype(np.int64) % BUCKETS
            counts += np.bincount((of * BUCKETS + bucket)[inside], minlength=n * BUCKETS)
    return counts.reshape(n, BUCKETS)


def digests(texts: list[str]) -> np.ndarray:
    """One digest (a row of bytes) for each text. Texts without a triplet have
    all buckets in the lowest quartile."""
    raw, bounds = flat_bytes(pa.array(texts, pa.large_string()))
    counts = bucket_counts(raw, bounds)
    ranked = np.sort(counts, axis=1)
    q1, q2, q3 = (ranked[:, BUCKETS * k // 4 - 1, None] for k in (1, 2, 3))
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).astype(np.uint8)
    body = codes[:, 0::4] | (codes[:, 1::4] << 2) | (codes[:, 2::4] << 4) | (codes[:, 3::4] << 6)
    size = np.diff(bounds)
    length = np.minimum(255, np.round(8 * np.log2(size + 1))).astype(np.uint8)
    top = np.maximum(q3, 1)
    ratios = np.hstack([np.minimum(255, 255 * q // top) for q in (q1, q2)]).astype(np.uint8)
    check = np.array([zlib.crc32(raw[a:b]) & 255 for a, b in zip(bounds[:-1], bounds[1:], strict=True)], np.uint8)
    return np.hstack([check[:, None], length[:, None], ratios, body]).astype(np.uint8)


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bounded difference scores of digests, row by row: quartile steps of the
    buckets (three steps count six), length in eighths of an octave, ratios."""
    steps = np.zeros(len(a), np.int64)
    for shift in (0, 2, 4, 6):
        d = np.abs(((a[:, 4:] >> shift) & 3).astype(np.int64) - ((b[:, 4:] >> shift) & 3))
        steps += np.where(d == 3, 6, d).sum(axis=1)
    wide = np.abs(a[:, :4].astype(np.int64) - b[:, :4])
    score = steps + LENGTH_WEIGHT * wide[:, 1] + RATIO_WEIGHT * wide[:, 2:].sum(axis=1) // 16 + (wide[:, 0] > 0)
    return np.minimum(score, int(LARGEST))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1.0 - difference(a, b) / LARGEST


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by the start of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


ROWS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
NAMES = [c.split()[0] for c in ROWS.split(", ")]


def _compare(ids: list, texts: list[str], following: list[str]) -> dict[str, list]:
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    own, other, after = digests(texts), digests(changed), digests(following)
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": [x.tobytes().hex() for x in own],
        "edited_fingerprint": [x.tobytes().hex() for x in other],
        "near_edited": likeness(own, other).tolist(),
        "near_next": likeness(own, after).tolist(),
    }


def fingerprints(docs: DataFrame) -> DataFrame:
    """Only the digests: doc_id, n_chars, fingerprint of every row of ``docs``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                        "fingerprint": pa.array([x.tobytes().hex() for x in digests(texts)], pa.string()),
                    }
                )

    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(make, "doc_id long, n_chars long, fingerprint string")


def edit_report(docs: DataFrame) -> DataFrame:
    """Digest every text and its edited text (see ``edited``; the following
    text is that of the next document in ascending doc_id, after the last the
    first) and compare digests with the edited and with the next text's.

    Null ids come first, ties are ordered by text; a null text is empty; a
    single document follows itself; other columns of ``docs`` are ignored.
    Documents are sorted over range partitions; only the first and last text of
    each partition leave it, to meet those of its neighbours.
    """

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), True
        ids: list = []
        texts: list[str] = []

        def out(ids: list, texts: list[str], last: bool) -> pa.RecordBatch:
            nonlocal first
            n = len(ids) if last else len(ids) - 1
            rows = _compare(ids[:n], texts[:n], (texts[1:] + [""])[:n])
            rows |= {"part": [part] * n, "head": [None] * n, "tail": [None] * n}
            if first:
                rows["head"][0], first = texts[0], False
            if last:
                rows["tail"][-1] = texts[-1]
            return pa.RecordBatch.from_pydict(
                {**{c: pa.array(v, pa.int64()) for c, v in rows.items() if c in ("doc_id", "n_chars", "part")},
                 **{c: pa.array(v, pa.string()) for c, v in rows.items() if c in ("edited_sha256", "fingerprint", "edited_fingerprint", "head", "tail")},
                 **{c: pa.array(v, pa.float64()) for c, v in rows.items() if c.startswith("near_")}}
            ).select([*NAMES, "part", "head", "tail"])

        for batch in batches:
            for lo, hi in text_slices(batch):
                ids += batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                texts += [t or "" for t in batch.column("text").slice(lo, hi - lo).to_pylist()]
                if len(ids) > 1:
                    yield out(ids, texts, False)
                    ids, texts = ids[-1:], texts[-1:]
        if ids:
            yield out(ids, texts, True)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch, "tail"):
                rows = _compare(*(batch.column(c).slice(lo, hi - lo).to_pylist() for c in ("doc_id", "tail", "following")))
                yield pa.RecordBatch.from_pydict(rows).cast(kinds)

    kinds = pa.schema([(n, pa.int64() if n in ("doc_id", "n_chars") else pa.float64() if n.startswith("near") else pa.string()) for n in NAMES])
    swept = written(
        docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text", "xxhash64(text) AS _tie")
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie", "text")
        .select("doc_id", "text")
        .mapInArrow(sweep, ROWS + ", part long, head string, tail string"),
        "digest-sweep",
    )
    # One row a partition, whatever the number of documents.
    heads = swept.filter("head IS NOT NULL").select("part", "head")
    order = heads.select("part").selectExpr(
        "part", "coalesce(lead(part) OVER (ORDER BY part), first(part) OVER (ORDER BY part ROWS UNBOUNDED PRECEDING)) AS next_part"
    )
    edges = (
        swept.filter("tail IS NOT NULL").select("doc_id", "tail", "part").join(order, "part")
        .join(heads.select(F.col("part").alias("next_part"), F.col("head").alias("following")), "next_part")
        .select("doc_id", "tail", "following")
    )
    return swept.filter("tail IS NULL").select(*NAMES).unionByName(edges.mapInArrow(finish, ROWS))
