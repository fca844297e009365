"""Toxicity by maximum-scoring segments."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from ledgerlens.llm import queries as q
from ledgerlens.llm import toxicity as t

SF = "/root/testdata/sf0.01"


def brute_segments(scores):
    """All maximal segments by the definition: the best segment, then both sides."""
    out = []

    def walk(lo, hi):
        best = (0.0, 0, 0)
        for a in range(lo, hi):
            for b in range(a + 1, hi + 1):
                s = float(sum(scores[a:b]))
                if s > best[0] + 1e-12 or (abs(s - best[0]) <= 1e-12 and s > 0 and b - a < best[2] - best[1]):
                    best = (s, a, b)
        if best[0] > 0:
            walk(lo, best[1])
            out.append(best)
            walk(best[2], hi)

    walk(0, len(scores))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_segments_equal_the_definition(seed):
    rng = np.random.default_rng(seed)
    scores = np.round(rng.normal(-0.3, 1.5, 25), 3)
    got = t.segments(scores)
    want = brute_segments(scores)
    assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
    assert np.allclose([s for s, _, _ in got], [s for s, _, _ in want])


def test_segments_without_positive_scores():
    assert t.segments(np.array([])) == []
    assert t.segments(np.array([-1.0, 0.0])) == []


def test_held_out_follows_crc32(spark):
    rows = spark.range(50).selectExpr("id AS doc_id", f"{t.held_out('id')} AS h").collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_op1_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = q.op1_segment_toxicity(spark, SF).collect()
    assert len(rows) == pq.read_metadata(f"{SF}/documents.parquet").num_rows
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    caught = [p for y, p in held if y == 1]
    alarms = [p for y, p in held if y == 0]
    assert sum(caught) >= 0.75 * len(caught) and sum(alarms) <= 0.02 * len(alarms)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, best long, score string, toxic string")


def test_odd_rows(spark):
    texts = ["nice calm words here"] * 30 + ["you rotten villain words"] * 30
    rows = [(k, f"{x} {k % 7}x{'abcdefgh'[k % 8]}", 1, "s", "t") for k, x in enumerate(texts)]
    rows += [(1000, None, None, None, None), (1001, "", None, None, None), (None, "rotten villain", 1, "", ""), (5, "again", 1, "", ""),
             (1002, "calm words " * 20000, 1, "", ""), (1003, "!!! 123", 1, "", "")]
    labels = spark.createDataFrame([(k, 0 if k < 30 else 1) for k in range(60)] + [(None, 1), (3, None), (1002, 0)], "doc_id long, toxic int")
    got = t.score(frame(spark, rows), labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id != 5}
    assert by[None].held_out is False
    assert by[1000].predicted == by[1001].predicted == by[1002].predicted == by[1003].predicted == 0
    assert t.score(frame(spark, []), labels).count() == 0
    nothing = t.score(frame(spark, rows), labels.limit(0)).collect()
    assert len(nothing) == len(rows) and all(r.score == 0 for r in nothing)


def test_stems_reach_unseen_words():
    model = {"villa*": 3.0, "rotten": 4.0}
    assert t.word_score("villainous", model) == 3.0 - t.DRIFT
    assert t.word_score("villa", model) == -t.DRIFT
    assert t.word_score("rotten", model) == 4.0 - t.DRIFT


def test_long_passages_add_up(spark):
    """A passage of several weak words is worth more than its best word."""
    rows = spark.sql("SELECT 1L AS doc_id, 100L AS _tox_words, array(6D) AS _tox_best UNION ALL SELECT 2L, 100L, array(6D, 6D, 6D) UNION ALL SELECT 3L, 100L, CAST(array() AS array<double>) UNION ALL SELECT 4L, 0L, CAST(array() AS array<double>)")
    judged = rows.selectExpr("doc_id", f"{t.evidence(1.0, -2.0)} AS _tox_evidence")
    got = {r.doc_id: (r._tox_evidence, r.p) for r in judged.selectExpr("doc_id", "_tox_evidence", f"{t.probability(0.1, [0.0, 1.0, 5.0, 9.0])} AS p").collect()}
    assert got[3] < got[1] < got[2] and got[4][0] == 0 and got[4][1] < 0.1


def test_keep_clean_leaves_rows_as_they_are(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = t.keep_clean(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert kept.columns == docs.columns
    gone = docs.exceptAll(kept)
    assert kept.exceptAll(docs).count() == 0 and 0 < gone.count() < 0.15 * docs.count()
