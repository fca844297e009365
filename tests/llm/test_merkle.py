"""Merkle manifests, against a tree built in plain Python."""

import hashlib
import zlib

import pyarrow.parquet as pq
import pytest

from ledgerlens.llm import merkle as m
from ledgerlens.llm import queries as q

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, idx int, n string, leaf int, path string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    out = []
    for k, v in enumerate(row[:5]):
        if v is not None:
            v = str(v)
            if lower and k == 4:
                v = "".join(c.lower() if "A" <= c <= "Z" else c for c in v)
        out.append("-" if v is None else f"{len(v.encode())}:{v}")
    return h(*out)


def climb(nodes, arity):
    """Root and each node's steps (slot, siblings)."""
    places, paths = [[k] for k in range(len(nodes))], [[] for _ in nodes]
    while len(nodes) > 1:
        above, held = [], []
        for lo in range(0, len(nodes), arity):
            run = nodes[lo : lo + arity]
            for slot in range(len(run)):
                for k in places[lo + slot]:
                    paths[k].append((slot, run[:slot] + run[slot + 1 :]))
            above.append(h(*run))
            held.append(sum(places[lo : lo + arity], []))
        nodes, places = above, held
    return nodes[0], paths


def plain(rows, arity=16):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = (own, *climb([leaf(r) for r in own], arity))
    root, tops = climb([trees[name][1] for name in names], arity)
    out = []
    for name, top in zip(names, tops, strict=True):
        own, subroot, paths = trees[name]
        for r, path in zip(own, paths, strict=True):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf(r, tampered)
            for slot, others in path + top:
                folded = h(*others[:slot], folded, *others[slot:])
            proof = h(*(s for _, others in path + top for s in others))
            out.append((r[0], leaf(r), subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_op12_on_all_documents(spark):
    rows = [tuple(r[c] for c in m.COLUMNS) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    got = rows_of(q.op12_sibling_merkle(spark, SF))
    assert got == plain(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def odd(spark, rows):
    return spark.createDataFrame([(*r, 7, "n", 3, "p") for r in rows], SCHEMA)


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_odd_rows(spark, arity):
    rows = [
        (1, "a", "en", 3, "Abc"), (2, "a", None, None, None), (3, "a", "", 0, ""), (3, "a", "", 0, ""), (None, "a", "en", 1, "X"),
        (4, None, "en", 2, "ÄÖ Z"), (5, "é", "en", 2, "z"), (6, "lone", "de", 9, "LONG " * 40_000), (7, "", "x", 1, "1:-"),
    ]
    rows += [(100 + k, "many", "en", k, f"Text {k}") for k in range(37)]
    assert rows_of(m.report(odd(spark, rows), arity)) == plain(rows, arity)


def test_small_tables(spark):
    assert m.report(odd(spark, [])).count() == 0
    one = [(9, "s", "en", 1, "Only")]
    got = rows_of(m.report(odd(spark, one)))
    assert got == plain(one) and got[0][1] == got[0][2] == got[0][3]
    for n in (16, 17):
        rows = [(k, "s", "en", k, f"T{k}") for k in range(n)]
        assert rows_of(m.report(odd(spark, rows))) == plain(rows)


def test_a_digest_tells_null_from_text_and_fields_apart(spark):
    got = spark.sql(f"SELECT {m.row_digest(['NULL', chr(39) + 'ab' + chr(39)])} = {m.row_digest([chr(39) + '-' + chr(39), chr(39) + 'ab' + chr(39)])}").first()[0]
    assert got is False
