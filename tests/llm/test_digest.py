"""Quartile bucket digests."""

import hashlib
import statistics

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from ledgerlens.llm import digest as d
from ledgerlens.llm import queries as q
from ledgerlens.llm.common import flat_bytes

SF = "/root/testdata/sf0.01"
ODD = [None, "", "a", "ab", "abc" * 3, "é" * 7, "same text twice", "same text twice", "\U0001f600" * 9 + "x", "long " * 50_000]


def plain_edit(rows):
    """(id, text, edited, next) in ascending id; null ids first, ties by a hash of the text."""
    out = []
    for k, (i, t) in enumerate(rows):
        n = len(t) // 4
        nxt = rows[(k + 1) % len(rows)][1]
        out.append((i, t, t[: len(t) - n] + nxt[:n], nxt))
    return out


def check(got, want):
    assert len(got) == len(want)
    by = {}
    for r in got:
        by.setdefault((r.doc_id, r.n_chars, r.edited_sha256), []).append(r)
    for i, t, e, nxt in want:
        r = by[i, len(t), hashlib.sha256(e.encode()).hexdigest()].pop()
        own, other, after = d.digests([t, e, nxt])
        assert (r.fingerprint, r.edited_fingerprint) == (own.tobytes().hex(), other.tobytes().hex())
        assert r.near_edited == d.likeness(own[None], other[None])[0] and r.near_next == d.likeness(own[None], after[None])[0]


def test_op7_on_all_documents(spark):
    rows = sorted((r["doc_id"], r["text"] or "") for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist())
    got = q.op7_quartile_digest(spark, SF).collect()
    check(got, plain_edit(rows))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    long = [r for r in got if r.n_chars > 500]
    assert statistics.median(r.near_edited for r in long) > statistics.median(r.near_next for r in long) + 0.2
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "h", None) for i, t in rows], "doc_id long, text string, part int, head string, tail string")


def test_odd_rows(spark):
    rows = [(10 + k, t) for k, t in enumerate(ODD)]
    check(d.edit_report(frame(spark, rows[::-1])).collect(), plain_edit([(i, t or "") for i, t in rows]))
    assert d.edit_report(frame(spark, [])).count() == 0
    check(d.edit_report(frame(spark, [(5, "only one text")])).collect(), plain_edit([(5, "only one text")]))
    got = d.edit_report(frame(spark, [(None, "no id"), (1, "x"), (1, "x"), (1, "x")])).collect()
    assert len(got) == 4 and sum(r.doc_id is None for r in got) == 1
    texts = {r.doc_id: r.fingerprint for r in d.fingerprints(frame(spark, rows)).collect()}
    assert texts[16] == texts[17] and len(texts) == len(rows)


def test_counts_equal_the_definition(monkeypatch):
    monkeypatch.setattr(d, "STEP", 7)
    texts = ["abcdefghijklmnop", "", "xy", "é" * 12, "a" * 30]
    raw, bounds = flat_bytes(pa.array(texts))
    whole = d.bucket_counts(raw, bounds)
    assert [int(c.sum()) for c in whole] == [sum(max(0, len(t.encode()) - third) for _, third in d.SPACINGS) for t in texts]
    for t, own in zip(texts, whole, strict=True):
        alone = d.bucket_counts(*flat_bytes(pa.array([t])))
        assert (alone[0] == own).all()


def test_difference_is_bounded_and_symmetric():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 256, (50, d.BYTES)).astype(np.uint8), rng.integers(0, 256, (50, d.BYTES)).astype(np.uint8)
    assert (d.difference(a, a) == 0).all() and (d.difference(a, b) == d.difference(b, a)).all()
    assert ((d.difference(a, b) >= 0) & (d.difference(a, b) <= d.LARGEST)).all()
