"""Approximate nearest neighbours by robust-pruned directed graphs.

Distinct vectors are dealt into shards of bounded size. In each shard a graph
is built: greedy (beam) searches for every vector over the graph so far propose
its neighbours, and relaxed distance pruning keeps a few in different
directions: a candidate goes when a kept one is closer to it by the factor
``RELAX`` than the vector itself. Kept edges are added backwards too, and
overfull nodes pruned again. A query runs a beam search in every shard; what
the beams find is scored exactly, in double precision, and merged.

Searches of a batch advance in step, so the work is matrix products.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

SHARD = 4096  # vectors of a shard, about
DEGREE = 24
BUILD_BEAM = 48
SEARCH_BEAM = 128
RELAX = 1.2  # on distances; squares are compared
ENTRIES = 16  # nodes that a search starts from
BATCH = 256
QUERY_BLOCK = 512  # queries of a task
TOP = 5


class Graph:
    """Unit vectors (float32) and the out-neighbours of each (-1: none)."""

    def __init__(self, unit: np.ndarray, edges: np.ndarray | None = None, seed: int = 7):
        self.unit = unit
        self.edges = np.full((len(unit), DEGREE), -1, np.int32) if edges is None else edges
        rng = np.random.default_rng(seed)
        middle = int((unit @ unit.mean(axis=0)).argmax()) if len(unit) else 0
        some = rng.choice(len(unit), min(ENTRIES, len(unit)), replace=False) if len(unit) else np.zeros(0, int)
        self.entries = np.unique(np.append(some, middle)).astype(np.int64) if len(unit) else np.zeros(0, np.int64)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search for unit queries: (nodes, similarities), best first, -1
        where the beam is not full."""
        n, q = len(self.unit), len(queries)
        seen = np.zeros((q, n + 1), bool)  # column n: no node
        seen[:, n] = True
        row = np.arange(q)[:, None]
        nodes = np.tile(self.entries[:beam], (q, 1))
        seen[row, nodes] = True
        score = queries @ self.unit[self.entries[:beam]].T
        pad = beam - nodes.shape[1]
        nodes = np.hstack([nodes, np.full((q, pad), -1)])
        score = np.hstack([score, np.full((q, pad), -np.inf, np.float32)])
        open_ = np.isfinite(score)
        while True:
            best = np.where(open_, score, -np.inf).argmax(axis=1)
            live = np.flatnonzero(open_[np.arange(q), best])
            if not len(live):
                break
            at = best[live]
            open_[live, at] = False
            near = self.edges[nodes[live, at]].astype(np.int64)
            near[near < 0] = n
            fresh = ~seen[live[:, None], near]
            seen[live[:, None], near] = True
            found = np.einsum("qd,qkd->qk", queries[live], self.unit[np.where(near < n, near, 0)])
            found[~fresh] = -np.inf
            every, each = np.hstack([score[live], found]), np.hstack([nodes[live], near])
            still = np.hstack([open_[live], fresh])
            keep = np.argpartition(-every, beam - 1, axis=1)[:, :beam]
            side = np.arange(len(live))[:, None]
            score[live], nodes[live] = every[side, keep], each[side, keep]
            open_[live] = still[side, keep] & np.isfinite(score[live])
        order = np.argsort(-score, axis=1, kind="stable")
        score = score[row, order]
        return np.where(np.isfinite(score), nodes[row, order], -1), score

    def prune(self, points: np.ndarray, candidates: np.ndarray, relax: float) -> np.ndarray:
        """Neighbours (rows of ``DEGREE``) for points among candidates (-1: none)."""
        valid = (candidates >= 0) & (candidates != points[:, None])
        own = np.where(valid, candidates, 0)
        vectors = self.unit[own]
        score = np.einsum("bd,bkd->bk", self.unit[points], vectors)
        order = np.argsort(np.where(valid, -score, np.inf), axis=1, kind="stable")
        side = np.arange(len(points))[:, None]
        own, vectors, valid = own[side, order], vectors[side, order], valid[side, order]
        # A node twice among the candidates counts once.
        ranked = np.sort(np.where(valid, own, -1 - np.arange(own.shape[1])), axis=1)
        if (np.diff(ranked, axis=1) == 0).any():
            for b in np.flatnonzero((np.diff(ranked, axis=1) == 0).any(axis=1)):
                first = np.zeros(own.shape[1], bool)
                first[np.unique(own[b], return_index=True)[1]] = True
                again = np.zeros(own.shape[1], bool)
                known: set[int] = set()
                for k in np.flatnonzero(valid[b]):
                    again[k] = int(own[b, k]) in known
                    known.add(int(own[b, k]))
                valid[b] &= ~again
        far = 2 - 2 * np.einsum("bd,bkd->bk", self.unit[points], vectors)
        out = np.full((len(points), DEGREE), -1, np.int32)
        alive, row = valid.copy(), np.arange(len(points))
        for k in range(DEGREE):
            pick = alive.argmax(axis=1)
            any_ = alive[row, pick]
            if not any_.any():
                break
            out[any_, k] = own[row, pick][any_]
            alive[row, pick] = False
            between = 2 - 2 * np.einsum("bd,bkd->bk", vectors[row, pick], vectors)
            alive &= ~(any_[:, None] & (relax * relax * between <= far))
        return out

    def build(self, seed: int = 11) -> None:
        """Two passes over the vectors: without, then with relaxed pruning."""
        n = len(self.unit)
        rng = np.random.default_rng(seed)
        if n <= DEGREE + 1:
            for i in range(n):
                rest = [j for j in range(n) if j != i]
                self.edges[i, : len(rest)] = rest
            return
        self.edges[:] = rng.integers(0, n, self.edges.shape)
        for relax in (1.0, RELAX):
            order = rng.permutation(n)
            for lo in range(0, n, BATCH):
                points = order[lo : lo + BATCH]
                found, _ = self.search(self.unit[points], BUILD_BEAM)
                self.edges[points] = self.prune(points, np.hstack([found, self.edges[points]]), relax)
                self._backwards(points, relax)

    def _backwards(self, points: np.ndarray, relax: float) -> None:
        """Let the neighbours of points know them; prune those with too many."""
        to = self.edges[points].ravel().astype(np.int64)
        back = np.repeat(points, DEGREE)[to >= 0]
        to = to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        start = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        length = np.diff(np.r_[start, len(to)])
        for lo in range(0, len(start), BATCH):
            s, m = start[lo : lo + BATCH], length[lo : lo + BATCH]
            wide = np.full((len(s), m.max()), -1, np.int64)
            slot = np.arange(m.max())[None, :] < m[:, None]
            wide[slot] = back[np.repeat(s - np.r_[0, np.cumsum(m)[:-1]], m) + np.arange(m.sum())]
            self.edges[to[s]] = self.prune(to[s], np.hstack([self.edges[to[s]].astype(np.int64), wide]), relax)


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, vec) of the rows that take part: not null, not zero, all finite."""
    return table.selectExpr(f"CAST({id_col} AS long) AS id", f"CAST({vector} AS array<double>) AS vec").filter(
        "id IS NOT NULL AND size(vec) > 0 AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(vec, x -> x <> 0)"
    )


def _unit(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors (double), their norms and unit vectors (single). Very large and
    very small components are scaled first, so that norms stay finite."""
    exact = np.array([np.asarray(r, np.float64) for r in rows])
    scaled = exact / np.abs(exact).max(axis=1, keepdims=True)
    norm = np.sqrt((scaled * scaled).sum(axis=1))
    return scaled, norm, (scaled / norm[:, None]).astype(np.float32)


INDEX = "shard long, dim int, n long, vecs binary, edges binary, owners array<array<long>>"


def build_index(vectors: DataFrame, top: int = TOP, shard_size: int = SHARD) -> DataFrame:
    """One row a shard: vectors, graph, and the least ``top`` + 1 ids of each
    distinct vector (enough for any answer, as equal vectors tie). Vectors of
    different lengths never share a shard. Every valid vector is indexed."""
    # Ranked within a vector map-side first: a vector that repeats without end stays short.
    few = vectors.selectExpr("id", "vec", "row_number() OVER (PARTITION BY vec ORDER BY id) AS r").filter(f"r <= {top + 1}")
    distinct = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("owners"))
    distinct = written(distinct, "graph-vectors")
    shards = distinct.groupBy(F.size("vec").alias("dim")).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(shard_size))).alias("shards"))
    dealt = distinct.withColumn("dim", F.size("vec")).join(shards, "dim").withColumn("shard", F.expr("pmod(xxhash64(vec), shards)"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[np.argsort([o[0] for o in pdf["owners"]], kind="stable")]
        exact = np.array([np.asarray(v, np.float64) for v in pdf["vec"]])
        graph = Graph(_unit(list(pdf["vec"]))[2])
        graph.build()
        return pd.DataFrame({
            "shard": [int(pdf["shard"].iloc[0])], "dim": [exact.shape[1]], "n": [len(exact)], "vecs": [exact.tobytes()],
            "edges": [graph.edges.tobytes()], "owners": [[[int(i) for i in o] for o in pdf["owners"]]],
        })

    # Few bytes but much work a shard: dealt out by number, shards are not coalesced into few tasks.
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(dealt.repartition(parts, "dim", "shard").groupBy("dim", "shard").applyInPandas(build, INDEX), "graph-index")


def search(index: DataFrame, queries: DataFrame, top: int = TOP, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest found for each query
    (id, vec), its own id left out; by cosine, ties to the smaller id. Queries
    meet vectors of their own length only."""
    counts = index.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = (
        queries.withColumn("dim", F.size("vec")).join(counts, "dim")
        .withColumn("block", F.expr(f"pmod(xxhash64(id), {blocks})"))
        .withColumn("shard", F.explode(F.expr("sequence(0L, shards - 1)")))
        .select("id", "vec", "dim", "block", "shard")
    )
    offered = index.withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))

    def find(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            own = left.iloc[0]
            scaled, norm, unit = _unit(list(np.frombuffer(own["vecs"], np.float64).reshape(int(own["n"]), -1)))
            graph = Graph(unit, np.frombuffer(own["edges"], np.int32).reshape(-1, DEGREE))
            owners = own["owners"]
            for lo in range(0, len(right), BATCH):
                part = right.iloc[lo : lo + BATCH]
                q_scaled, q_norm, q_unit = _unit(list(part["vec"]))
                nodes, _ = graph.search(q_unit, max(beam, top + 1))
                for k, qid in enumerate(part["id"]):
                    near = nodes[k][nodes[k] >= 0]
                    exact = scaled[near] @ q_scaled[k] / (norm[near] * q_norm[k])
                    found = []
                    for i in np.argsort(-exact, kind="stable"):
                        if len(found) >= top and exact[i] < found[top - 1][0]:
                            break
                        found += [(float(exact[i]), int(o)) for o in owners[near[i]] if o != qid]
                        found.sort(key=lambda p: (-p[0], p[1]))
                    out += [(int(qid), o, s) for s, o in found[:top]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    hits = offered.groupBy("dim", "shard", "block").cogroup(asked.groupBy("dim", "shard", "block")).applyInPandas(find, "query_id long, vec_id long, score double")
    return hits.selectExpr(
        "query_id", "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank", "vec_id", "score"
    ).filter(f"rank <= {top}")


def nearest(table: DataFrame, every: int = 50, top: int = TOP) -> DataFrame:
    """Nearest vectors of the rows whose vec_id is divisible by ``every``, among
    all other rows. Null ids take no part; rows that repeat a vec_id with the
    same vector are the same candidate; an id with several vectors asks and
    answers with each."""
    vectors = written(valid_vectors(table).dropDuplicates(["id", "vec"]), "graph-valid")
    return search(build_index(vectors, top), vectors.filter(f"id % {every} = 0"), top)
