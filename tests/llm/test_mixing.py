"""Mixing by hash thresholds, against sorting in plain Python."""

import hashlib
import re

import pytest

from ledgerlens.llm import mixing as x
from ledgerlens.llm import queries as q

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, text string, size string, hash string, target int, own int"


def plain(rows, weights=(1, 2, 3)):
    docs = []
    for i, source, text in rows:
        key = str(i) if i is not None else "-" + (text or "")
        docs.append((i, source, len(re.findall(r"[^\x20\x09-\x0D]+", text or "")), int(hashlib.md5(key.encode()).hexdigest()[:15], 16)))
    names = sorted({d[1] for d in docs}, key=lambda s: (s is None, s or ""))
    held = {s: sum(d[2] for d in docs if d[1] == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, set(names), sum(held.values())
    while free:
        over = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] > 3 * held[s] * over}
        if not full:
            target |= {s: left * weight[s] / over for s in free}
            break
        target |= {s: 3.0 * held[s] for s in full}
        free, left = free - full, left - sum(3 * held[s] for s in full)
    out = []
    for s in names:
        own = [d for d in docs if d[1] == s]
        copies = int(target[s] // held[s]) if held[s] else 0
        budget = target[s] - copies * held[s]
        cuts = [0, *sorted({d[3] + 1 for d in own if d[2]})]
        cut = min(cuts, key=lambda c: (abs(sum(d[2] for d in own if d[3] < c) - budget), c)) if budget > 0 else 0
        out += [(d[0], d[2], held[s], target[s], d[2] * (copies + (d[3] < cut))) for d in own]
    return out


def key(r):
    return repr((r[0], r[1], r[2], round(r[3], 6), r[4]))


def check(got, rows):
    want = plain(rows)
    assert sorted(map(key, map(tuple, got))) == sorted(map(key, want))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "h", 1, 2) for r in rows], SCHEMA)


def test_op13_is_near_its_targets(spark):
    got = q.op13_threshold_mix(spark, SF).collect()
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").collect()}
    by = {}
    for r in got:
        by.setdefault(sources[r.doc_id], []).append(r)
    for rows in by.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows) / 2
        assert all(r.taken <= 3 * r.size for r in rows)
    assert abs(sum(rows[0].target for rows in by.values()) - sum(r.size for r in got)) < 1e-3


ODD = [
    (1, "a", "one two three"), (2, "a", None), (3, "a", ""), (None, "a", "no id here"), (None, "a", "no id here"), (None, "a", None),
    (4, None, "w " * 900), (5, None, "x y"), (6, "", "tab\tand\nline\x0bend"), (7, "empty", None), (8, "empty", " \t "),
    (9, "long", "word " * 50_000), (9, "long", "again"), (10, "é", "é ü"), (11, "\U0001f600", "a b c d"),
]


@pytest.mark.parametrize("sent", [50_000, 0])
def test_odd_rows(spark, monkeypatch, sent):
    monkeypatch.setattr(x, "SENT_SOURCES", sent)
    rows = ODD + [(100 + k, f"s{k % 7}", "w " * (k % 40)) for k in range(400)]
    check(x.mix(frame(spark, rows)).collect(), rows)
    check(x.mix(frame(spark, rows[::-1]).repartition(7)).collect(), rows)


def test_small_tables(spark):
    assert x.mix(frame(spark, [])).count() == 0
    for rows in ([(1, "a", None)], [(1, "a", "b c")], [(1, "a", "b c"), (2, "b", "d e f g h"), (3, "c", "i")]):
        check(x.mix(frame(spark, rows)).collect(), rows)


def test_targets_stop_at_three_times_the_size(spark):
    rows = [(k, "big", "w " * 100) for k in range(50)] + [(100, "small", "x y z"), (101, "tiny", "q")]
    got = x.mix(frame(spark, rows)).collect()
    assert {(r.source_size, r.target) for r in got} == {(3, 9.0), (1, 3.0), (5000, 4992.0)}
    assert {r.taken for r in got if r.source_size < 10} == {9, 3}
    check(got, rows)


def test_thresholds_nest(spark):
    rows = x.sizes(frame(spark, [(k, "s", "w " * (1 + k % 9)) for k in range(300)]))
    total = rows.groupBy().sum("size").first()[0]
    last = -1
    for share in (0.1, 0.35, 0.36, 0.9):
        cut = x.thresholds(rows, spark.createDataFrame([("s", total * share)], "source string, budget double"), 1).first().threshold
        assert cut >= last
        last = cut
