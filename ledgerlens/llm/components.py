"""Connected components of an edge table, by large-star and small-star rounds.

Edges that lie together are contracted first: a task keeps a spanning forest of
them, every node at the least of its tree. Each round then lets every node point
its neighbours at the least of them; the edge table is written between rounds and
shrinks to a star for each component. A node's neighbours are never gathered: minima
are aggregated, and joined back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

CONTRACTED = 1 << 18  # edges that are contracted at a time: a memory bound of a task


def forest(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least that edges (x, y) connect it with."""
    root = np.arange(n)
    while True:
        a, b = root[x], root[y]
        if (a == b).all():
            return root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) that connect what the given ones connect, one at most for each
    node of those that are held at a time."""

    def forests(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = [pa.chunked_array([x.column(k) for x in held]).combine_chunks() for k in (0, 1)]
        coded = pa.concat_arrays(ends).dictionary_encode()
        names, code = coded.dictionary, np.asarray(coded.indices)
        order = np.asarray(pc.array_sort_indices(names))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        code = place[code]
        root = forest(code[: len(ends[0])], code[len(ends[0]) :], len(order))
        moved = np.flatnonzero(root != np.arange(len(order)))
        return pa.RecordBatch.from_arrays([names.take(pa.array(order[moved])), names.take(pa.array(order[root[moved]]))], names=["a", "b"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CONTRACTED:
            yield forests(held)
            held, rows = [], 0
    if rows:
        yield forests(held)


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges a > b of spanning forests of what each task reads."""
    kind = edges.schema["a"].dataType.simpleString()
    return (
        edges.filter("a <> b").select("a", "b").mapInArrow(contract, f"a {kind}, b {kind}")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    )


def _star(edges: DataFrame, node: str, other: str) -> DataFrame:
    """For each ``node`` the least of itself and its ``other`` ends. A join deals it
    out, as it grows with the edges."""
    least = edges.groupBy(node).agg(F.min(other).alias("m")).select(F.col(node).alias("n"), F.least(F.col(node), F.col("m")).alias("m"))
    return least.hint("merge")


def _stars(edges: DataFrame) -> bool:
    """Whether every node points at one other only, which points at none: then
    the edges (which may repeat), which keep what they connect, are the components."""
    ends = edges.selectExpr("a AS v", "b AS other", "0 AS taken").unionByName(edges.selectExpr("b AS v", "NULL AS other", "1 AS taken"))
    counts = ends.groupBy("v").agg(F.min("other").alias("low"), F.max("other").alias("high"), F.max("taken").alias("taken"))
    return counts.filter("low <> high OR low IS NOT NULL AND taken > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b of one orderable
    type; self-loops, repeated and null ends are ignored), root being the least
    node of its component."""
    now = written(_contracted(edges), "component-edges")
    while not _stars(now):
        # Large star: the larger neighbours of a node go to its least one.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _star(both, "a", "b")
        large = both.join(least, F.col("a") == F.col("n")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its smaller neighbours go to the least one.
        least = _star(large, "a", "b")
        small = large.join(least, F.col("a") == F.col("n")).select("a", "b", "m")
        ends = small.select("a", F.col("m").alias("b")).union(small.filter("b <> m").select("b", "m"))
        # Written first: a scan reads many small files in one task, which contracts more.
        now = written(_contracted(written(ends.distinct(), "component-ends")), "component-edges")
    # Each root for itself too; different tasks may have written the same edge.
    return now.selectExpr("a AS node", "b AS root").unionByName(now.selectExpr("b AS node", "b AS root")).distinct()
