"""Token ids, packed id files and sequence packing."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import bitpack, packing, wordids
from ledgerlens.llm import queries as q

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "plain words here.", "It's they'll I'd 're 'x", "café café İstanbul ßa ªº ǅa",
    "a\x1cb\x1fc d e　f", "x" * 5000, "mixed123abc 12.5% _under_ <|endoftext|> <|startoftext|>x", "ΣΟΣ Σ",
    "tabs\tand\nlines\r\nend .", "word., word,. Word.", "é. É, ×. ÷, ª. e\u0301. \u0301. …. it's. 'S, don'T.", "x.y z.,  a\x0bb\x0c.", ". , .,", "ǅ. ȿ. ɏ. ɐ.",
    "<|ENDOFTEXT|>", "\U0001f600 emoji️ 中文", "a" * 150 + ".",
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(wordids.default_path())


def plain_ids(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids


def test_word_cache_equals_the_tokenizer(plain):
    texts = pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist() + ODD
    coder = wordids.WordIds(wordids.default_path())
    for _ in range(2):
        for text, ids in zip(texts, coder.encode(texts), strict=True):
            assert ids.tolist() == plain_ids(plain, text)


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 31, 32])
def test_pack_round_trip(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 2**bits, 1001, dtype=np.uint64).astype(np.uint32)
    raw = bitpack.pack(ids, bits)
    assert len(raw) == -(-1001 * bits // 8)
    assert (bitpack.unpack(raw, bits, 1001) == ids).all()


def test_pack_refuses_wide_ids():
    with pytest.raises(ValueError):
        bitpack.pack(np.array([4], np.uint32), 2)


def test_bits_for():
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 256, 257, 49408, 65537)] == [1, 1, 2, 8, 9, 16, 17]


def test_random_access(tmp_path):
    from pyarrow import fs

    rng = np.random.default_rng(5)
    docs = [(k if k % 7 else None, rng.integers(0, 40000, n, dtype=np.uint32)) for k, n in enumerate([1, 0, 5000, 64, 65, 12000, 3])]
    store = fs.LocalFileSystem()
    w = bitpack.Writer(store.open_output_stream(str(tmp_path / "f")), 17, block=64)
    for d, ids in docs:
        w.add(d, ids)
    w.close()
    every = np.concatenate([x for _, x in docs])
    with store.open_input_file(str(tmp_path / "f")) as f:
        r = bitpack.Reader(f)
        for lo, hi in [(0, 1), (63, 65), (100, 100), (4000, 9001), (0, len(every))]:
            assert (r.ids(lo, hi) == every[lo:hi]).all()
        assert [(d, ids.tolist()) for d, _, ids in r.documents()] == [(d, x.tolist()) for d, x in docs]


def expected_files(rows, plain):
    start, out = 0, []
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*plain_ids(plain, text), 2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op2_on_all_documents(spark, plain):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    got = sorted(tuple(r) for r in q.op2_bit_packed_ids(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == sorted(expected_files(rows, plain))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", None) for d, t in rows], "doc_id long, text string, shard string, base long")


def test_op2_odd_rows(spark, plain):
    rows = [(10 * k, t) for k, t in enumerate(ODD)] + [(None, "no id")]
    got = bitpack.token_files(spark, frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected_files(rows, plain), key=str)
    twice = bitpack.token_files(spark, frame(spark, [(3, "same"), (3, "same"), (3, None)])).collect()
    assert sorted(r.start for r in twice)[0] == 0 and len(twice) == 3
    assert bitpack.token_files(spark, frame(spark, [])).count() == 0


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_op10_on_all_documents(spark, plain):
    rows = q.op10_swap_packing(spark, SF).collect()
    texts = dict(pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pandas().itertuples(index=False))
    want = set()
    for d, t in texts.items():
        ids = np.array([*plain_ids(plain, t), 1], "<u4")
        want |= {(d, k, 4096 * k, len(ids[4096 * k :][:4096]), zlib.crc32(ids[4096 * k :][:4096].tobytes())) for k in range(-(-len(ids) // 4096))}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    assert check_packing(rows, 4096) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_op10_odd_rows(spark):
    rows = packing.pack_documents(frame(spark, [(k, t) for k, t in enumerate(ODD)] + [(None, None), (1, ""), (1, "")])).collect()
    check_packing(rows, 4096)
    assert len(rows) == len(ODD) + 3
    assert packing.pack_documents(frame(spark, [])).count() == 0


def test_groups_meet_again(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), 0, 0, int(n), 0) for k, n in enumerate(rng.integers(1, 100, 3000))]
    items = spark.createDataFrame(rows, packing.PIECES)
    packed = packing.pack(items, capacity=100, group_items=300).collect()
    assert len(packed) == 3000
    bins, least = check_packing(packed, 100), -(-sum(r[3] for r in rows) // 100)
    assert bins <= least + 0.03 * least


def test_local_search_empties_bins():
    # 6+3, 5+4, 1: two exchanges make 6+4, 5+3+1
    lengths = np.array([6, 3, 5, 4, 1])
    bins = packing.local_search(lengths, np.array([0, 0, 1, 1, 2]), 10)
    assert len(set(bins.tolist())) == 2
    fill = np.bincount(bins, weights=lengths)
    assert fill.max() <= 10


@pytest.mark.parametrize("seed", range(6))
def test_local_search_never_loses_ground(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 60, 200)
    start = packing.best_fit(lengths, 100)
    bins = packing.local_search(lengths, start, 100)
    square = lambda b: (np.bincount(b, weights=lengths) ** 2).sum()
    assert np.bincount(bins, weights=lengths).max() <= 100
    assert square(bins) >= square(start)


def test_sequences_hold_their_ids(spark, plain):
    texts = [*ODD, "word " * 9000]
    rows = packing.pack_documents(frame(spark, list(enumerate(texts)))).collect()
    by, spans = {}, {}
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        by.setdefault(r.doc_id, []).append((r.start, r.ids))
        spans.setdefault(r.sequence_id, []).append((r.offset, r.ids))
    for d, t in enumerate(texts):
        assert [i for _, ids in sorted(by[d]) for i in ids] == [*plain_ids(plain, t), 1]
    sequences = [[i for _, ids in sorted(own) for i in ids] for own in spans.values()]
    assert sum(map(len, sequences)) == sum(r.length for r in rows) and max(map(len, sequences)) <= 4096
