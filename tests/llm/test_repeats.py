"""Repeated byte strings: suffix arrays, maximal repeats, removal."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerlens.llm import queries as q
from ledgerlens.llm import repeats as r
from ledgerlens.llm.common import flat_bytes

SF = "/root/testdata/sf0.01"


def brute_ranges(texts, width):
    """Removed byte mask of each text, by the definition."""
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for raw in raws:
        for i in range(len(raw) - width + 1):
            w = raw[i : i + width]
            seen[w] = seen.get(w, 0) + 1
    masks = []
    for raw in raws:
        mask = np.zeros(len(raw), bool)
        for i in range(len(raw) - width + 1):
            if seen[raw[i : i + width]] > 1:
                mask[i : i + width] = True
        masks.append(mask)
    return raws, masks


def brute_report(rows, width):
    raws, masks = brute_ranges([t for _, t in rows], width)
    out = []
    for (d, _), raw, m in zip(rows, raws, masks, strict=True):
        kept = np.frombuffer(raw, np.uint8)[~m].tobytes()
        runs = int(np.count_nonzero(np.diff(np.r_[0, m.astype(int)]) == 1))
        out.append((d, len(raw), int(m.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_maximal(texts, least):
    """Maximal repeats by trying every substring."""
    found = {}
    for t, raw in enumerate(texts):
        for a in range(len(raw)):
            for b in range(a + least, len(raw) + 1):
                found.setdefault(raw[a:b], []).append((t, a))
    out = set()
    for s, places in found.items():
        if len(places) < 2:
            continue
        left = {texts[t][a - 1] if a else ("start", t) for t, a in places}
        right = {texts[t][a + len(s)] if a + len(s) < len(texts[t]) else ("end", t) for t, a in places}
        if len(left) > 1 and len(right) > 1:
            out.add((s, tuple(sorted(places))))
    return out


@pytest.mark.parametrize("seed", range(25))
def test_maximal_repeats_equal_the_definition(seed):
    rng = random.Random(seed)
    texts = [bytes(rng.choice(b"ab" if seed % 2 else b"abcd") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 5))]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    got = set()
    for depth, at in r.maximal_repeats(data, bounds, 2):
        of = np.searchsorted(bounds, at, side="right") - 1
        places = tuple(sorted((int(o), int(a - bounds[o])) for o, a in zip(of, at, strict=True)))
        t, a = places[0]
        got.add((texts[t][a : a + depth], places))
    assert got == brute_maximal(texts, 2)


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array_orders_long_repeats(seed):
    rng = random.Random(seed)
    piece = bytes(rng.choice(b"xyz") for _ in range(100))
    texts = [piece * 4, piece * 3 + b"q", b"", b"z" * 333, piece[50:] + piece]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    rest = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(data))
    sa, lcp = r.suffix_array(data, rest)
    tails = [data[p : p + rest[p]].tobytes() for p in sa]
    assert tails == sorted(tails)
    for a, b, n in zip(tails, tails[1:], lcp[1:], strict=False):
        want = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert n == want


def test_equal_windows_have_equal_anchors(monkeypatch):
    monkeypatch.setattr(r, "CHUNK", 100)
    rng = random.Random(3)
    shared = "".join(rng.choice("abcdefgh") for _ in range(90))
    texts = [shared, "zz" + shared + "q" * 70, "short", None, shared[20:] * 2]
    raw, bounds = flat_bytes(pa.array(texts))
    anchor_of = {}
    for anchor, _, of, start, length in r.contexts(raw, bounds, 40, 8):
        for a, o, s, n in zip(anchor, of, start, length, strict=True):
            for p in range(s, s + n - 39):
                w = raw[bounds[o] + p : bounds[o] + p + 40].tobytes()
                assert anchor_of.setdefault(w, a) == a
                assert p + 40 <= bounds[o + 1] - bounds[o]
    windows = sum(max(0, len(t or "") - 39) for t in texts)
    assert len({t[i : i + 40] for t in texts if t for i in range(len(t) - 39)}) == len(anchor_of) <= windows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "k", "s") for d, t in rows], "doc_id long, text string, size int, key string, start string")


def made_up(seed, alphabet="abcdefghijklmnopqrstuvwxyz é"):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [word(rng.randint(30, 120)) for _ in range(4)]
    rows = []
    for d in range(40):
        t = "".join(word(rng.randint(0, 40)) + (rng.choice(shared)[rng.randint(0, 10) :] if rng.random() < 0.6 else "") for _ in range(rng.randint(0, 5)))
        rows.append((d, t))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, None), (103, ""), (None, rows[5][1]), (3, "x" * 300), (104, "ab" * 200), (7, shared[0] * 3)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_brute_force(spark, seed):
    rows = made_up(seed)
    got = sorted(map(tuple, r.report(frame(spark, rows), 40, 8).collect()), key=str)
    assert got == brute_report(rows, 40)


def test_crowded_anchors_count_windows(spark, monkeypatch):
    monkeypatch.setattr(r, "GATHERED", 2)
    rows = made_up(4)
    got = sorted(map(tuple, r.report(frame(spark, rows), 40, 8).collect()), key=str)
    assert got == brute_report(rows, 40)


def test_op8_on_all_documents(spark):
    rows = [tuple(x.values()) for x in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    got = sorted(map(tuple, q.op8_interval_repeats(spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)
    assert got == brute_report(rows, 200)


def test_remove_keeps_rows_and_columns(spark):
    docs = frame(spark, made_up(5))
    got = r.remove(docs, 40, 8)
    assert got.columns == docs.columns
    rows, masks = made_up(5), brute_ranges([t for _, t in made_up(5)], 40)
    want = sorted(str((d, None if t is None else np.frombuffer(raw, np.uint8)[~m].tobytes().decode("utf-8", "ignore"))) for (d, t), raw, m in zip(rows, *masks, strict=True))
    assert sorted(str((x.doc_id, x.text)) for x in got.collect()) == want


def test_empty_table(spark):
    assert r.report(frame(spark, [])).count() == 0
    assert r.remove(frame(spark, [(1, None), (2, "")])).count() == 2
