"""Word-shingle Jaccard join."""

import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerlens.llm import components as cc
from ledgerlens.llm import jaccard as j
from ledgerlens.llm import queries as q
from ledgerlens.llm.common import flat_bytes
from ledgerlens.llm.shingles import shingle_sets

SF = "/root/testdata/sf0.01"


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute_classes(rows):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    seen = set()
    for own in by.values():
        for k, a in enumerate(own):
            for b in own[k + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                        root[find(a)] = find(b)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((d, len(s), ids.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


ODD = [None, "", " \t\n\x0b\x0c\r ", "one", "One", "a b c d", "A B  C\nD", "a b c d e", "a\xa0b c d e", "É é Å å x", "d c b a", "x " * 3000, "x " * 7]


def family(seed, n=40, words=60):
    """Edited copies of a seed text, at many rates of edits."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = f"e{rng.randint(0, 9999)}"
        out.append(" ".join(own))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "s", 3, b"n") for d, t in rows], "doc_id long, text string, node string, n int, marks binary")


def test_shingles_equal_the_definition():
    texts = ODD + family(1, 5) + ["y" * 3_000_000 + " tail of words that follow it"]
    sets = shingle_sets(*flat_bytes(pa.array(texts)))
    want = [brute_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(w) for w in want]
    for a in range(len(texts)):
        for b in range(a):
            assert len(np.intersect1d(sets[a], sets[b])) == len(want[a] & want[b])


@pytest.mark.parametrize("seed", range(8))
def test_traversal_loses_no_link(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for n in rng.integers(1, 400, 30):
        base = rng.integers(0, 2**64, n, dtype=np.uint64)
        for _ in range(rng.integers(1, 12)):
            keep = base[rng.random(n) > rng.random() * 0.3]
            new = rng.integers(0, 2**64, rng.integers(0, 1 + n // 10), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([keep, new])))
    sets = [s for s in sets if len(s)]
    half = len(sets) // 2
    sizes, marks = np.array([len(s) for s in sets]), [j.signature(s, int(rng.integers(1, 9))) for s in sets]
    words = max(map(len, marks)) // 8 if seed % 2 else 16
    is_link = lambda a, b: j.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))
    whole = j.Tree(sizes, marks, words)
    got = {tuple(sorted(p)) for p in zip(*(x.tolist() for x in j.traverse(whole, whole)), strict=True)}
    every = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))]
    assert {p for p in every if is_link(*p)} <= got and all(a != b for a, b in got)
    assert len(got) < len(every) / 3
    left, right = j.Tree(sizes[:half], marks[:half], words), j.Tree(sizes[half : half + 5], marks[half : half + 5], words)
    got = set(zip(*(x.tolist() for x in j.traverse(left, right)), strict=True))
    assert {(a, b) for a in range(half) for b in range(5) if is_link(a, b + half)} <= got
    one = j.Tree(sizes[:1], marks[:1], words)
    assert len(j.traverse(one, one)[0]) == 0


@pytest.mark.parametrize("seed", range(4))
def test_prefixes_of_linked_sets_meet(seed):
    rng = np.random.default_rng(seed)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) > 0.2], rng.integers(0, 2**64, rng.integers(0, 12), dtype=np.uint64)]))
        late = np.sort(rng.choice(x, rng.integers(0, len(x) + 1), replace=False))
        if len(y) and j.linked(len(np.intersect1d(x, y)), len(x), len(y)):
            assert len(np.intersect1d(j.prefix(x, late), j.prefix(y, late)))


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 200), (200, 150), (7, 7), (300, 301), (301, 300), (None, 5)]
    got = {r.node: r.root for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(51)}, 100: 100, 200: 100, 150: 100, 300: 300, 301: 300}
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_need_few_rounds(spark, monkeypatch):
    # Edges that lie together are contracted: a long path took a round for each doubling.
    names, real = [], cc.written
    monkeypatch.setattr(cc, "written", lambda df, name: (names.append(name), real(df, name))[1])
    edges = [(f"{k:04}", f"{k + 1:04}") for k in range(2000)]
    random.Random(3).shuffle(edges)
    rows = cc.components(spark.createDataFrame(edges, "a string, b string").repartition(4)).collect()
    assert {r.node: r.root for r in rows} == {f"{k:04}": "0000" for k in range(2001)} and len(rows) == 2001
    assert names.count("component-edges") <= 6


def test_contracted_edges_connect_the_same(monkeypatch):
    monkeypatch.setattr(cc, "CONTRACTED", 40)
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 150, (2, 120))
    names = np.array([bytes([200 - k, k]) for k in range(150)], object)
    batches = [pa.RecordBatch.from_pydict({"a": pa.array(names[x[k : k + 20]], pa.binary()), "b": pa.array(names[y[k : k + 20]], pa.binary())}) for k in range(0, 120, 20)]
    got = [(p["a"], p["b"]) for b in cc.contract(iter(batches)) for p in b.to_pylist()]
    place = {n: k for k, n in enumerate(names)}
    after = cc.forest(*(np.array([place[p[k]] for p in got]) for k in (0, 1)), 150)
    assert (after == cc.forest(x, y, 150)).all()
    assert len(got) <= 120 and all(a > b for a, b in got)
    assert list(cc.contract(iter([]))) == []


def test_op5_on_all_documents(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    got = sorted(map(tuple, q.op5_signature_trees(spark, SF).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == brute_classes(rows)


@pytest.mark.parametrize("leaf", [64, 3])
def test_families_and_odd_rows(spark, monkeypatch, leaf):
    monkeypatch.setattr(j, "LEAF", leaf)
    monkeypatch.setattr(j, "BLOCK", 16)
    monkeypatch.setattr(j, "SLICE", 3000)
    texts = ODD + family(1) + family(2, 90) + family(3, 25, 8)
    rows = [(1000 - k if k % 9 else None, t) for k, t in enumerate(texts)] + [(1, texts[20]), (1, texts[20]), (2, texts[20]), (3, "w1 other")]
    got = sorted(map(tuple, j.classes(frame(spark, rows)).collect()), key=str)
    assert got == brute_classes(rows)


def test_one_of_each(spark):
    texts = family(5, 12)
    rows = [(k + 5, t) for k, t in enumerate(texts)] + [(None, ""), (None, ""), (4, None), (4, "alone here"), (4, "alone here"), (None, "no id one"), (None, "no id two"), (None, texts[0])]
    docs = frame(spark, rows)
    got = j.one_of_each(docs)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    classes = {}
    for d, _, c in brute_classes(rows):
        classes.setdefault(c, []).append(d)
    assert sorted(d for d, t in kept if d and t and t.startswith("w")) == sorted({c for _, n, c in brute_classes(rows[:12])})
    assert kept.count((None, "")) == 2 and kept.count((4, None)) == 1 and kept.count((4, "alone here")) == 1
    assert (None, "no id one") in kept and (None, "no id two") in kept


def test_empty_table(spark):
    assert j.classes(frame(spark, [])).count() == 0
    assert j.one_of_each(frame(spark, [])).count() == 0


def test_a_group_of_a_family_holds_two_blocks_at_most(spark, monkeypatch):
    """Each call gets one pair of blocks, and a family that is one component
    does not meet block by block."""
    plain, kept = j.block_links, {}

    def single(pdf, percent=j.PERCENT):
        if len(pdf[["family", "i", "j"]].drop_duplicates()) != 1:
            raise ValueError("several pairs of blocks in one group")
        return plain(pdf, percent)

    def keep(df, name):
        kept[name] = real(df, name)
        return kept[name]

    real = j.written
    monkeypatch.setattr(j, "block_links", single)
    monkeypatch.setattr(j, "written", keep)
    monkeypatch.setattr(j, "BLOCK", 40)
    base = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join([*base[:99], f"e{k}", *base[100:]])) for k in range(400)] + [(1000 + k, t) for k, t in enumerate(family(4, 90))]
    got = sorted(map(tuple, j.classes(frame(spark, rows)).collect()), key=str)
    assert got == brute_classes(rows)
    near = len(rows) - 90
    blocks = kept["jaccard-block-pairs"].groupBy("_family").count().collect()
    # All pairs of ten blocks would be 55; the other family has few blocks.
    assert near // 40 == 10 and sum(r["count"] for r in blocks) < 30


def test_nodes_of_hot_shingles_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(j, "SAMPLE_SHARE", 1)
    monkeypatch.setattr(j, "HOT_COUNT", 30)
    monkeypatch.setattr(j, "BLOCK", 40)
    rows = list(enumerate([*ODD, *family(6, 120), *family(7, 20), *family(8, 70, 9)]))
    docs = frame(spark, rows)
    late, hot = j.frequent(docs.selectExpr("coalesce(text, '') AS text"))
    assert 0 < len(hot) < len(late)
    made = j.entries(docs.selectExpr("doc_id", "0L AS copy", "coalesce(text, '') AS text"), late, hot=hot)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert made.filter(f"bucket >= {parts}").select("bucket").distinct().count() > 10
    assert sorted(map(tuple, j.classes(docs).collect()), key=str) == brute_classes(rows)


def test_blocks_hash_their_texts_in_slices(monkeypatch):
    """The sets of a block are those of its whole texts, hashed a slice at a time."""
    texts = pa.array([f"{'one two three four five six ' * (k % 7)}{k}" for k in range(60)] + ["", None], pa.large_string())
    whole = shingle_sets(*flat_bytes(texts))
    seen = []
    monkeypatch.setattr(j, "SLICE", 500)
    monkeypatch.setattr(j, "shingle_sets", lambda raw, bounds: seen.append(len(raw)) or shingle_sets(raw, bounds))
    sets = j.sliced_sets(texts)
    assert max(seen) <= 500 and len(seen) > 5
    assert len(sets) == len(whole) and all((a == b).all() for a, b in zip(sets, whole, strict=True))
    own = pd.DataFrame({"family": 1, "node": [bytes([k]) for k in range(60)], "text": texts.to_pylist()[:60], "part": 1, "i": 1, "j": 1})
    seen.clear()
    j.block_links(own)
    assert seen and max(seen) <= 500


def chance(n, near=10):
    """Texts of which each shares a few shingles with many others, and near copies of some."""
    rng = random.Random(11)
    common = [" ".join(f"c{rng.randint(0, 99999)}" for _ in range(5)) for _ in range(30)]
    texts = []
    for _ in range(n):
        parts = [" ".join(f"w{rng.randint(0, 99999)}" for _ in range(12)) for _ in range(5)]
        texts.append(" ".join(x for p in parts for x in (p, rng.choice(common))))
    return texts + [f"{t} and more" for t in texts[:near]]


def test_texts_that_share_few_shingles_are_left_aside(spark, monkeypatch):
    """Pairs met by chance grow with the square of the input: a text most of whose
    shingles stand in no other one is neither dealt out nor looked up."""
    kept = {}

    def keep(df, name):
        kept[name] = real(df, name)
        return kept[name]

    real = j.written
    monkeypatch.setattr(j, "written", keep)
    rows = list(enumerate([*chance(300), "", "alone", None]))
    assert sorted(map(tuple, j.classes(frame(spark, rows)).collect()), key=str) == brute_classes(rows)
    assert kept["jaccard-texts"].count() == 20
    assert kept["jaccard-met"].select("a", "b").distinct().count() == 10


@pytest.mark.parametrize("slice_nodes", [1 << 16, 7])
def test_shared_nodes_hold_every_link(spark, monkeypatch, slice_nodes):
    monkeypatch.setattr(j, "SLICE", 2000)
    monkeypatch.setattr(j, "SLICE_NODES", slice_nodes)
    texts = [*ODD, *family(21), *family(22, 30, 8), *chance(60), *family(21)[:5]]
    docs = spark.createDataFrame([(t or "",) for t in texts], "text string").repartition(3)
    got = {bytes(r.node) for r in j.shared_nodes(docs).collect()}
    nodes = dict(zip(j.fingerprints(sets := j.sliced_sets(pa.array([t or "" for t in texts]))), sets, strict=True))
    nodes.pop(None)
    linked = {a for a, x in nodes.items() for b, y in nodes.items() if a != b and j.linked(len(np.intersect1d(x, y)), len(x), len(y))}
    assert linked <= got and len(got) < len(nodes) - 40


def test_prefixes_by_counts_meet():
    rng = np.random.default_rng(9)
    late = np.zeros(0, np.uint64)
    for _ in range(300):
        x = np.unique(rng.integers(0, 2**64, int(rng.integers(1, 60)), dtype=np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) > 0.2], rng.integers(0, 2**64, rng.integers(0, 12), dtype=np.uint64)]))
        count = lambda s: (s >> np.uint64(7)) % np.uint64(5)
        if len(y) and j.linked(len(np.intersect1d(x, y)), len(x), len(y)):
            heads = [j.prefix(s, late, counts=count(s)) for s in (x, y)]
            assert len(np.intersect1d(*heads))
            assert all((np.diff(count(h).astype(int)) >= 0).all() for h in heads)
