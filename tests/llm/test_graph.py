"""Nearest neighbours by pruned graphs."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from ledgerlens.llm import graph_index as g
from ledgerlens.llm import queries as q

SF = "/root/testdata/sf0.01"


def brute(rows, every, top):
    """Nearest by cosine in double precision, ties to the smaller id."""
    rows = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and len(v) and None not in v
            and np.isfinite(np.array(v, np.float64)).all() and np.any(np.array(v, np.float64))]
    out = {}
    for i, v in rows:
        if i % every == 0:
            near = sorted((-float(v @ w / (math.sqrt(v @ v) * math.sqrt(w @ w))), j) for j, w in rows if j != i and len(w) == len(v))
            out[i] = [(j, -s) for s, j in near[:top]]
    return out


def answers(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len({j for j, _ in got.get(i, [])} & {j for j, _ in w}) for i, w in want.items()) / sum(len(w) for w in want.values())


def test_op3_on_all_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    want, got = brute(rows, 50, 5), answers(q.op3_pruned_graph(spark, SF).collect())
    assert set(got) == set(want) and recall(got, want) >= 0.95
    exact = {(i, j): s for i, w in brute(rows, 50, len(rows)).items() for j, s in w}
    assert all(abs(s - exact[i, j]) < 1e-12 for i, w in got.items() for j, s in w)


@pytest.mark.parametrize("clusters", [1, 30])
def test_recall_of_a_shard(clusters):
    rng = np.random.default_rng(clusters)
    centres = rng.normal(size=(clusters, 32)) * (2 if clusters > 1 else 0)
    unit = (centres[rng.integers(0, clusters, 3000)] + rng.normal(size=(3000, 32))).astype(np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    graph = g.Graph(unit)
    graph.build()
    assert all(len(set(e[e >= 0])) == (e >= 0).sum() and i not in e for i, e in enumerate(graph.edges))
    nodes, score = graph.search(unit[:200], g.SEARCH_BEAM)
    best = np.argsort(-(unit[:200] @ unit.T), axis=1)[:, :6]
    assert np.mean([len(set(a[:6]) & set(b)) / 6 for a, b in zip(nodes, best, strict=True)]) >= 0.95
    assert (np.diff(score[np.isfinite(score).all(axis=1)]) <= 1e-6).all()


def test_pruning_keeps_different_directions():
    unit = np.array([[1, 0], [0.99, 0.1], [0.98, 0.12], [0.0, 1.0], [0.7, 0.7]], np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    kept = g.Graph(unit).prune(np.array([0]), np.array([[1, 2, 3, 4, -1, 0, 2]]), 1.0)[0]
    assert kept[0] == 1 and 2 not in kept


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<float>, shard string, rank int")


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)]) for i in range(1, 120)]
    rows += [(200, None), (150, []), (250, [0.0, 0.0, 0.0, 0.0]), (300, [1.0, None, 2.0, 1.0]), (350, [1.0, math.nan, 1.0, 1.0]), (400, [math.inf, 1.0, 1.0, 1.0]),
             (None, [1.0, 1.0, 1.0, 1.0]), (450, [1.0, 2.0]), (451, [2.0, 4.0]), (500, [1.0, 2.0, 3.0]), (550, [1e30, 1e30, 0.0, 1e30]), (600, [1e-30, 0.0, 0.0, 1e-30])]
    rows += [(i, rows[49][1]) for i in range(1000, 1040)] + [(50, rows[49][1])]
    want, got = brute(rows[:-1], 50, 5), answers(g.nearest(frame(spark, rows)).collect())
    assert {k: [j for j, _ in v] for k, v in got.items()} == {k: [j for j, _ in v] for k, v in want.items() if v}
    assert [j for j, _ in got[50]] == [1000, 1001, 1002, 1003, 1004]
    assert g.nearest(frame(spark, [])).count() == 0 and g.nearest(frame(spark, [(50, [1.0])])).count() == 0


def test_several_shards(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(700)]
    vectors = g.valid_vectors(frame(spark, rows))
    index = g.build_index(vectors, 5, 200)
    assert index.count() == 4 and index.selectExpr("sum(n)").first()[0] == 700
    got = answers(g.search(index, vectors.filter("id % 50 = 0")).collect())
    assert recall(got, brute(rows, 50, 5)) >= 0.95
