"""Merkle manifest of a dataset: every row a leaf, a tree for each group, and a
tree over the groups' roots.

Levels are tables of nodes (group, place, digest). At each level every node is
joined with itself shifted: it computes the places of its siblings (the place XOR
1 in a binary tree, else the offsets of its run's slots) and an equality join
fetches them, so the work of a level spreads by (group, place) and a hot group is
spread like any other. The node in slot zero has its whole run then and emits the
parent. Nodes keep their siblings: they are the steps of the proofs, which are put
together from the root downwards, one join a level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written
from ledgerlens.llm.numbering import numbered, same

ARITY = 16
HEX = 64  # digits of a digest
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "array<struct<slot:int,siblings:binary>>"
NOTHING = "CAST(NULL AS STRING)"  # the payload of nodes that are no leaves


def framed(value: str) -> str:
    """SQL: a value as its length in bytes, a colon and its text; ``-`` if null."""
    text = f"CAST({value} AS STRING)"
    return f"coalesce(concat(CAST(octet_length({text}) AS STRING), ':', {text}), '-')"


def row_digest(values: Sequence[str] = COLUMNS) -> str:
    """SQL: the digest of a row's values, as hexadecimal text."""
    return f"sha2(concat({', '.join(framed(v) for v in values)}), 256)"


def _siblings(arity: int) -> str:
    """SQL: the places of the run of a node, its own included."""
    if arity == 2:
        return "array(idx, idx ^ 1L)"
    return f"transform(sequence(0, {arity - 1}), k -> idx - pmod(idx, {arity}L) + pmod(pmod(idx, {arity}L) + k, {arity}L))"


def level(nodes: DataFrame, arity: int, name: str) -> DataFrame:
    """Nodes (g, idx, n, digest, payload) with ``siblings``: the digests of the
    rest of their run, in order, joined. The node meets itself too, which keeps
    its own columns; what it fetches of others is their digest alone."""
    wanted = nodes.selectExpr("g", "idx", "n", f"explode({_siblings(arity)}) AS place").filter("place < n").drop("n")
    held = nodes.selectExpr("g AS g2", "idx AS place2", "n", "digest", "payload")
    met = wanted.join(held, same("g", "g2") & F.expr("place = place2")).selectExpr(
        "g", "idx", "CASE WHEN place = idx THEN named_struct('n', n, 'digest', digest, 'payload', payload) END AS own",
        "CASE WHEN place <> idx THEN named_struct('place', place, 'digest', digest) END AS other",
    )
    runs = met.groupBy("g", "idx").agg(F.expr("first(own, true) AS own"), F.expr("sort_array(collect_list(other)) AS others"))
    joined = "aggregate(others, CAST('' AS BINARY), (all, o) -> concat(all, o.digest))"
    return written(runs.selectExpr("g", "idx", "own.n", "own.digest", f"{joined} AS siblings", "own.payload"), name)


def parents(nodes: DataFrame, arity: int) -> DataFrame:
    """The nodes above: one from each slot-zero node of a group that is not done."""
    above = "unhex(sha2(lower(hex(concat(digest, siblings))), 256)) AS digest"
    return nodes.filter(f"n > 1 AND pmod(idx, {arity}L) = 0").selectExpr("g", f"idx DIV {arity}L AS idx", f"(n + {arity - 1}L) DIV {arity}L AS n", above, f"{NOTHING} AS payload")


def tree(leaves: DataFrame, arity: int, name: str) -> list[DataFrame]:
    """All levels of the trees of the groups of ``leaves`` (g, idx, n, digest,
    payload, which stays with the leaves); a group's root is its node with n = 1."""
    most = leaves.agg(F.expr("max(n)")).first()[0]
    levels, nodes = [], leaves
    while most is not None:
        levels.append(level(nodes, arity, f"{name}-{len(levels)}"))
        nodes, most = parents(levels[-1], arity), -(-most // arity) if most > 1 else None
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """g, digest: the root of each group."""
    done = [t.filter("n = 1").select("g", "digest") for t in levels]
    out = done[0]
    for t in done[1:]:
        out = out.unionByName(t)
    return out


def steps(levels: list[DataFrame], above: DataFrame, arity: int, name: str) -> DataFrame:
    """The leaves (g, idx, digest, payload) with ``path``: slot and siblings from
    the leaf to its group's root, then the path that ``above`` (g, path, subroot)
    goes on with. A level joins its nodes with the paths of their parents."""
    kept = ["g", "idx", "digest", "payload"]
    paths = None
    step = f"array(named_struct('slot', CAST(pmod(idx, {arity}L) AS INT), 'siblings', siblings))"
    onward = above.selectExpr("g AS g2", "path AS rest", "subroot")
    for k in range(len(levels) - 1, -1, -1):
        nodes = levels[k]
        own = nodes.filter("n = 1").join(onward, same("g", "g2")).selectExpr(*kept, "rest AS path", "subroot")
        if paths is not None:
            up = paths.selectExpr("g AS g2", "idx AS up", "path AS rest", "subroot")
            below = nodes.filter("n > 1").join(up, same("g", "g2") & F.expr(f"idx DIV {arity}L = up"))
            own = own.unionByName(below.selectExpr(*kept, f"concat({step}, rest) AS path", "subroot"))
        paths = written(own, f"{name}-{k}") if k else own
    return paths


def fold(leaf: str) -> str:
    """SQL: the root that a leaf's digest and ``path`` lead to."""
    others = "lower(hex(p.siblings))"
    return (
        f"aggregate(path, {leaf}, (h, p) -> sha2(concat(substr({others}, 1, {HEX} * p.slot), h,"
        f" substr({others}, {HEX} * p.slot + 1)), 256))"
    )


PROOF = "sha2(array_join(transform(path, p -> lower(hex(p.siblings))), ''), 256)"


def manifest(leaves: DataFrame, arity: int = ARITY) -> DataFrame:
    """Every row of ``leaves`` (group, a text; key; leaf, 32 bytes; payload, any
    one column) as group, leaf, payload, subroot, root (hexadecimal) and ``path``, the
    steps of its proof. Leaves of a group ascend by key, null keys first, rows
    with one key by leaf; equal leaves are interchangeable. Groups ascend by
    their bytes, the null group first. An empty table gives no rows."""
    placed = written(numbered(leaves, "group", ["key", "leaf"], "merkle-leaves").drop("key"), "merkle-places")
    levels = tree(placed.selectExpr("group AS g", "idx", "n", "leaf AS digest", "payload"), arity, "merkle-level")
    if not levels:
        return placed.selectExpr("group", "leaf", "payload", "hex(leaf) AS subroot", "hex(leaf) AS root", f"CAST(NULL AS {STEP}) AS path")
    subroots = numbered(roots(levels).selectExpr("g AS group", "digest"), None, ["group"], "merkle-subroots")
    subroots = written(subroots, "merkle-subroot-places")
    top = tree(subroots.selectExpr("CAST(NULL AS STRING) AS g", "idx", "n", "digest", "group AS payload"), arity, "merkle-top")
    root = roots(top).first().digest.hex()
    start = top[-1].filter("n = 1").selectExpr("g", f"CAST(array() AS {STEP}) AS path", "CAST(NULL AS STRING) AS subroot")
    over = steps(top, start, arity, "merkle-top-path")
    above = written(over.selectExpr("payload AS g", "path", "lower(hex(digest)) AS subroot"), "merkle-above")
    paths = steps(levels, above, arity, "merkle-path")
    return paths.selectExpr("g AS group", "digest AS leaf", "payload", "subroot", f"'{root}' AS root", "path")


def report(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """Manifest and proofs of documents, and a test by tampering: where 5
    divides the crc32 of the id's decimal text, the leaf is recomputed with A-Z of
    the text in lower case and folded along the untampered siblings.

    Nulls count as ``-``, so they differ from empty values; a row without id is
    never tampered with, nor is a null text changed. Columns of ``docs`` beyond
    the five are ignored, repeated rows are leaves of their own."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = [c if c != "text" else f"translate(text, '{upper}', '{upper.lower()}')" for c in COLUMNS]
    tampered = f"CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN unhex({row_digest(lowered)}) END"
    leaves = docs.select(*COLUMNS).selectExpr(
        "CAST(source AS STRING) AS group", "CAST(doc_id AS BIGINT) AS key", f"unhex({row_digest()}) AS leaf",
        f"named_struct('doc_id', CAST(doc_id AS BIGINT), 'tampered', {tampered}) AS payload",
    )
    # Digests are made once: ranging reads its rows twice.
    out = manifest(written(leaves, "merkle-digests"), arity)
    folded = out.selectExpr(
        "payload.doc_id", "lower(hex(leaf)) AS leaf", "subroot", "root", f"{PROOF} AS proof_sha256",
        f"{fold('lower(hex(coalesce(payload.tampered, leaf)))')} AS folded_root",
    )
    return folded.selectExpr("*", "folded_root = root AS verified")
