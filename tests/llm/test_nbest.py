"""N-best SentencePiece segmentation."""

import itertools
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from ledgerlens.llm import nbest as n
from ledgerlens.llm import queries as q

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  two  spaces ", "▁ literal ▁▁ mark", "日本語 \U0001f600", "tabs\tand\nlines", "a" * 300, "x" * 70 + " " + "the " * 400, "é\x00\x01"]


@pytest.fixture(scope="module")
def lattice():
    return n.Lattice(n.default_path())


def brute(lattice, text, most):
    """All segmentations of a marked text by recursion, best first."""
    text = n.marked(text)

    def walk(at):
        if at == len(text):
            yield 0.0, ()
            return
        for end in range(at + 1, min(len(text), at + lattice.longest) + 1):
            for start, score, ids in lattice._into(text, end):
                if start == at:
                    for s, rest in walk(end):
                        yield score + s, ids + rest

    return sorted(walk(0), key=lambda x: -x[0])[:most]


@pytest.mark.parametrize("text", ["", "a", "the cat", "hello th", "a b a", "日x", "  a", "anan"])
def test_best_segmentations_equal_the_definition(lattice, text):
    got, want = lattice.segment(text), brute(lattice, text, lattice.n)
    assert np.allclose([s for s, _ in got], [s for s, _ in want])
    assert len({ids for _, ids in got}) == len(got)
    every = dict((ids, s) for s, ids in brute(lattice, text, 10**6))
    assert all(abs(every[ids] - s) < 1e-9 for s, ids in got)


def test_decoding_is_the_inverse(lattice):
    texts = [t or "" for t in pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()[:60] + ODD]
    for t in texts:
        found = lattice.segment(t)
        assert all(lattice.decode(ids) == t for _, ids in found)
        scores = [s for s, _ in found]
        assert scores == sorted(scores, reverse=True) and len(found) <= lattice.n


def test_words_of_a_text_combine_exactly(lattice):
    text = "thing of the day or"
    words = [lattice.word(n.SPACE + w) for w in text.split()]
    every = sorted((sum(c[0] for c in pick) for pick in itertools.product(*words)), reverse=True)
    assert np.allclose([s for s, _ in lattice.segment(text)], every[: lattice.n])


def test_forward_pass_equals_the_search(lattice):
    words = ["▁the", "▁▁a", "thing", "▁日x", "▁" + "ab" * 20, "a\nb", "\udc81", "▁heonou", "zz", "▁", "▁" + "x" * 60]
    for w in words:
        want = lattice.word(w)
        if len(w) <= n.LONG_WORD:
            best, gap, ids = lattice._forward([w, w], len(w))
            assert abs(best[0] - want[0][0]) < 1e-9 and (best == best[0]).all()
            assert gap[0] == np.inf if len(want) == 1 else abs(gap[0] - (want[0][0] - want[1][0])) < 1e-9
            assert len(want) > 1 and want[1][0] == want[0][0] or tuple(ids[0].tolist()) == want[0][1]


def test_tables_start_anew(lattice, monkeypatch):
    texts = [t or "" for t in pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()[:20]]
    want = [lattice.segment(t) for t in texts]
    monkeypatch.setattr(n, "KNOWN_WORDS", 10)
    monkeypatch.setattr(n, "SEARCHED_WORDS", 2)
    again = n.Lattice(n.default_path())
    assert [again.segment(t) for t in texts] == want
    assert [[(s, tuple(i.tolist())) for s, i in f] for f, _ in again.segment_all(texts)] == want


def test_op9_on_all_documents(spark):
    rows = q.op9_nbest_pieces(spark, SF).collect()
    assert len(rows) == pq.read_metadata(f"{SF}/documents.parquet").num_rows
    assert all(r.decodes and 1 <= r.n_found <= n.N_BEST and r.scores[0] == r.best_score for r in rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(k if k else None, t, 1, "s") for k, t in enumerate([*ODD, "same", "same"])], "doc_id long, text string, n_found int, scores string")
    rows = n.encode(docs).collect()
    assert len(rows) == len(ODD) + 2 and all(r.decodes for r in rows)
    assert n.encode(docs.limit(0)).count() == 0


def test_encode_keeps_the_ids_and_decode_is_its_inverse(spark, lattice, monkeypatch):
    monkeypatch.setattr(n, "BATCH_IDS", 50)
    texts = [*ODD, "the cat sat on the mat", "the cat sat on the mat"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    encoded = n.encode(docs)
    for r in encoded.collect():
        want = lattice.segment(texts[r.doc_id] or "")
        assert [tuple(ids) for ids in r.ids] == [ids for _, ids in want]
        assert [zlib.crc32(np.array(ids, "<u4").tobytes()) for ids in r.ids] == r.ids_crc32
    got = {r.doc_id: r.texts for r in n.decode(encoded).collect()}
    assert all(set(got[k]) == {t or ""} for k, t in enumerate(texts)) and len(got) == len(texts)
    assert "ids" not in q.op9_nbest_pieces(spark, SF).columns
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<array<int>>")
    assert [r.texts for r in n.decode(none).collect()] == [None]
