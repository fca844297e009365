"""Registered queries of the subpackage and their DuckDB SQL (where SQL can
express the result)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import bitpack, digest, graph_index, jaccard, kneser_ney, merkle, mixing, nbest, packing, repeats, secret_scan, toxicity, whitening
from ledgerlens.llm.common import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op2_bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.token_files(spark, documents(spark, sf_dir))


@query
def op3_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_index.nearest(table(spark, sf_dir, "embeddings"))


@query
def op4_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op5_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(documents(spark, sf_dir))


@query
def op6_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query
def op7_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.edit_report(documents(spark, sf_dir))


@query
def op8_interval_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(documents(spark, sf_dir))


@query
def op9_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.encode(documents(spark, sf_dir)).drop("ids")


@query
def op10_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir)).drop("ids")


@query
def op11_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


@query
def op12_sibling_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(documents(spark, sf_dir))


@query
def op13_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


# --- SQL -----------------------------------------------------------------------

# All pairs of documents that share a shingle, and the closure of their links.
ORACLE_SQL["op5_signature_trees"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(words) >= 5
                      THEN list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
                      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles
  FROM split
),
each AS MATERIALIZED (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reached AS (
  SELECT doc_id AS u, doc_id AS v FROM sets
  UNION
  SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u
)
SELECT s.doc_id, CAST(len(any_value(s.shingles)) AS BIGINT) AS n_shingles, min(r.v) AS component_id
FROM sets s JOIN reached r ON r.u = s.doc_id
GROUP BY s.doc_id
"""

# Every 200-byte window of every text, in hexadecimal; islands of the places
# whose window occurs more than once.
ORACLE_SQL["op8_interval_repeats"] = """
WITH texts AS MATERIALIZED (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes FROM documents
),
places AS MATERIALIZED (
  SELECT doc_id, p, md5_number(substring(h, 2 * p + 1, 400)) AS w
  FROM (SELECT doc_id, h, unnest(range(0, greatest(n_bytes - 199, 0))) AS p FROM texts)
),
repeated AS MATERIALIZED (SELECT doc_id, p FROM places SEMI JOIN (SELECT w AS k FROM places GROUP BY w HAVING count(*) > 1) ON w = k),
islands AS (
  SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS island
  FROM (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 200 THEN 0 ELSE 1 END AS fresh FROM repeated)
),
spans AS MATERIALIZED (SELECT doc_id, island, min(p) AS lo, max(p) + 200 AS hi FROM islands GROUP BY doc_id, island),
kept AS (
  SELECT s.doc_id, substring(h, 2 * coalesce(lag(hi) OVER (PARTITION BY s.doc_id ORDER BY lo), 0) + 1,
                             2 * (lo - coalesce(lag(hi) OVER (PARTITION BY s.doc_id ORDER BY lo), 0))) AS part, lo AS place
  FROM spans s JOIN texts t ON t.doc_id = s.doc_id
  UNION ALL
  SELECT t.doc_id, substring(h, 2 * coalesce(e.hi, 0) + 1), n_bytes + 1
  FROM texts t LEFT JOIN (SELECT doc_id, max(hi) AS hi FROM spans GROUP BY doc_id) e ON e.doc_id = t.doc_id
)
SELECT t.doc_id, n_bytes, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(r.k, 0) AS BIGINT) AS n_spans,
       sha256(unhex(j.rest)) AS kept_sha256
FROM texts t
JOIN (SELECT doc_id, string_agg(part, '' ORDER BY place) AS rest FROM kept GROUP BY doc_id) j ON j.doc_id = t.doc_id
LEFT JOIN (SELECT doc_id, sum(hi - lo) AS n, count(*) AS k FROM spans GROUP BY doc_id) r ON r.doc_id = t.doc_id
"""

# Trees from the bottom to the top by recursion; proofs from lists of whole runs.
ORACLE_SQL["op12_sibling_merkle"] = """
WITH RECURSIVE framed AS MATERIALIZED (
  SELECT doc_id, source, text,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))),
           lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))) AS crc
  FROM documents
),
leaves AS MATERIALIZED (
  SELECT doc_id, source AS g, leaf, CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN changed ELSE leaf END AS tampered,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS changed
        FROM framed)
),
nodes AS (
  SELECT g, 0 AS l, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT g, l + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY g, l, idx // 16, n
),
runs AS MATERIALIZED (SELECT g, l, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM nodes WHERE n > 1 GROUP BY g, l, idx // 16),
subroots AS MATERIALIZED (
  SELECT g, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1
),
tops AS (
  SELECT 0 AS l, idx, n, subroot AS h FROM subroots
  UNION ALL
  SELECT l + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY l, idx // 16, n
),
topruns AS MATERIALIZED (SELECT l, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM tops WHERE n > 1 GROUP BY l, idx // 16),
climbed AS (
  SELECT doc_id, leaf, g, 0 AS l, idx, n, tampered AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT doc_id, leaf, g, l + 1, idx // 16, (n + 15) // 16, sha256(before || h || after), proof || before || after
  FROM (SELECT c.*, coalesce(array_to_string(hs[1:idx % 16], ''), '') AS before, coalesce(array_to_string(hs[idx % 16 + 2:], ''), '') AS after
        FROM climbed c JOIN runs r ON c.g IS NOT DISTINCT FROM r.g AND c.l = r.l AND c.idx // 16 = r.run WHERE c.n > 1)
),
over_groups AS (
  SELECT c.doc_id, c.leaf, s.subroot, 0 AS l, s.idx, s.n, c.h, c.proof FROM climbed c JOIN subroots s ON c.g IS NOT DISTINCT FROM s.g WHERE c.n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, l + 1, idx // 16, (n + 15) // 16, sha256(before || h || after), proof || before || after
  FROM (SELECT c.*, coalesce(array_to_string(hs[1:idx % 16], ''), '') AS before, coalesce(array_to_string(hs[idx % 16 + 2:], ''), '') AS after
        FROM over_groups c JOIN topruns r ON c.l = r.l AND c.idx // 16 = r.run WHERE c.n > 1)
)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, o.h AS folded_root, o.h = t.h AS verified
FROM over_groups o, (SELECT h FROM tops WHERE n = 1) t WHERE o.n = 1
"""

# Shares in closed form over the sources in order of how soon they are full;
# thresholds by a running sum over the sorted hashes.
ORACLE_SQL["op13_threshold_mix"] = r"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-' || coalesce(text, ''))), 1, 15) AS BIGINT) AS hash
  FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM docs GROUP BY source
),
fullness AS (
  SELECT *, row_number() OVER soon AS k, 3 * source_size / weight AS ratio,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (soon ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
         sum(weight) OVER () - coalesce(sum(weight) OVER (soon ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights
  FROM sources WINDOW soon AS (ORDER BY 3 * source_size / weight, source NULLS LAST)
),
share AS (SELECT k, words, weights FROM fullness WHERE words <= ratio * weights ORDER BY k LIMIT 1),
aims AS MATERIALIZED (
  SELECT f.source, f.source_size, CASE WHEN f.k < s.k THEN CAST(3 * f.source_size AS DOUBLE) ELSE CAST(s.words AS DOUBLE) * f.weight / CAST(s.weights AS DOUBLE) END AS target
  FROM fullness f, share s
),
plan AS MATERIALIZED (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies,
         CASE WHEN source_size > 0 THEN target - CAST(CAST(floor(target / source_size) AS BIGINT) * source_size AS DOUBLE) ELSE 0 END AS budget
  FROM aims
),
running AS (
  SELECT source, hash, sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) AS up_to, sum(size) AS own FROM docs WHERE size > 0 GROUP BY source, hash
),
cuts AS (
  SELECT r.source, max(CASE WHEN up_to < budget OR (up_to - own < budget AND up_to - budget < budget - (up_to - own)) THEN hash END) AS last
  FROM running r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source WHERE budget > 0 GROUP BY r.source
)
SELECT d.doc_id, d.size, p.source_size, p.target, CAST(d.size * (p.copies + CASE WHEN d.hash <= c.last THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""
