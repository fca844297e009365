"""Mixing sources to target weights by hash thresholds.

A document's hash decides whether it is in its source's share: those below a
threshold are. Thresholds come from histograms: tokens are added up by source and
hash bucket, the bucket where a source's budget ends is found, and only that bucket is
cut further, until it holds a single hash. Thresholds nest: a larger
budget keeps all that a smaller one took. Nothing is sorted, and the documents
are filtered by one comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written
from ledgerlens.llm.numbering import numbered, same

WEIGHTS = (1, 2, 3)  # of the sources in order, repeating
REPEATS = 3  # most copies of a document
HASH_BITS, STEP_BITS = 60, 10
# Sources up to which their table (under 100 bytes a row) is sent to all tasks;
# beyond, rows of a source are dealt to several tasks.
SENT_SOURCES, SALTS = 50_000, 64

SIZE = r"coalesce(CAST(regexp_count(text, '[^\\x20\\x09-\\x0D]+') AS BIGINT), 0L)"
# Rows without an id are told apart by their text.
HASH = "CAST(conv(substr(md5(coalesce(CAST(doc_id AS STRING), concat('-', coalesce(text, '')))), 1, 15), 16, 10) AS BIGINT)"


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words), hash of every document."""
    rows = docs.select("doc_id", "source", "text").selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(source AS STRING) AS source", f"{SIZE} AS size", f"{HASH} AS hash")
    return written(rows, "mix-sizes")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Each source (source, source_size) with its ``target``. Sources by code
    point, null last, have the weights in turn and share all words by weight; a
    target stops at ``repeats`` times its source's size, and what is beyond is
    shared again by weight among the others until none is above."""
    placed = numbered(sources, None, ["source IS NULL", "source"], "mix-sources")
    turn = f"array({', '.join(map(str, weights))})[CAST(pmod(idx, {len(weights)}L) AS INT)]"
    weighed = written(placed.selectExpr("source", "source_size", f"CAST({turn} AS BIGINT) AS weight"), "mix-weights")
    share, over, stopped = "CAST(0 AS DECIMAL(20,0))", "1L", -1
    while True:
        # Shares are share / over for each unit of weight; compared as whole numbers.
        above = f"CAST({share} * weight AS DECIMAL(38,0)) > CAST(CAST({repeats}L * source_size AS DECIMAL(20,0)) * {over} AS DECIMAL(38,0))"
        state = weighed.agg(
            F.expr(f"count_if({above}) AS stopped"),
            F.expr(f"coalesce(sum(source_size), 0L) - coalesce(sum(CASE WHEN {above} THEN {repeats}L * source_size END), 0L) AS words"),
            F.expr(f"coalesce(sum(CASE WHEN NOT ({above}) THEN weight END), 0L) AS weights"),
        ).first()
        if state.stopped == stopped or not state.weights:
            break
        stopped, share, over = state.stopped, f"CAST({state.words} AS DECIMAL(20,0))", f"{state.weights}L"
    target = f"CASE WHEN {above} THEN CAST({repeats}L * source_size AS DOUBLE) ELSE CAST({share} AS DOUBLE) * weight / {over} END"
    return written(weighed.selectExpr("source", "source_size", f"{target} AS target"), "mix-targets")


def by_source(rows: DataFrame, sources: DataFrame, count: int) -> DataFrame:
    """Rows joined with their source's row (its column ``source`` renamed ``own``)."""
    if count <= SENT_SOURCES:
        return rows.join(F.broadcast(sources), same("source", "own"))
    dealt = sources.selectExpr("*", f"explode(sequence(0L, {SALTS - 1}L)) AS own_salt")
    salted = rows.selectExpr("*", f"pmod(hash, {SALTS}L) AS salt")
    return salted.join(dealt, same("source", "own") & F.expr("salt = own_salt")).drop("salt", "own_salt")


def thresholds(rows: DataFrame, budgets: DataFrame, count: int) -> DataFrame:
    """source, threshold for each row of ``budgets`` (source, budget): the words
    of its documents with a hash below the threshold are as near to the budget as a
    threshold can bring them (ties: the smaller one). ``rows``: source, size, hash."""
    state = budgets.filter("budget > 0").selectExpr("source AS own", "budget", "0L AS below", "0L AS prefix")
    left, shift, done = rows.filter("size > 0"), HASH_BITS, False
    while not done:
        inside = by_source(left, state, count).filter(f"shiftright(hash, {shift}) = prefix").select("source", "size", "hash", "budget", "below")
        left = written(inside, "mix-boundary") if shift < HASH_BITS else inside
        shift -= STEP_BITS
        buckets = left.groupBy("source", F.expr(f"shiftright(hash, {shift}) AS bucket")).agg(
            F.expr("sum(size) AS words"), F.expr("max(budget) AS budget"), F.expr("max(below) AS below"),
            F.expr("min(hash) AS least"), F.expr("max(hash) AS most"),
        )
        run = "OVER (PARTITION BY source ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND"
        summed = buckets.selectExpr("*", f"below + sum(words) {run} CURRENT ROW) AS up_to", f"below + coalesce(sum(words) {run} 1 PRECEDING), 0L) AS before")
        # The bucket where the budget ends; it exists, as a budget is at most its source's size.
        ends = written(summed.filter("before < budget AND up_to >= budget"), "mix-ends")
        state = ends.selectExpr("source AS own", "budget", "before AS below", "bucket AS prefix")
        left = left.select("source", "size", "hash")
        done = shift == 0 or ends.filter("least < most").isEmpty()
    return ends.selectExpr("source", "least + CASE WHEN up_to - budget < budget - before THEN 1L ELSE 0L END AS threshold")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Every document with doc_id, size, source_size, target (its source's) and
    taken: the words the mix takes of it, copies counted. Each document of a source is
    taken as often as the target holds the whole source, and once more if its hash is
    below the threshold for the rest; never more than ``repeats`` times.

    A null text has no words; a source without words has target 0. A null source
    is a source of its own, null ids are told apart by text. Rows with equal ids go
    together, as they have one hash; other columns are ignored. The result depends
    on the rows alone, not on their order or partitions."""
    rows = sizes(docs)
    sources = rows.groupBy("source").agg(F.expr("sum(size) AS source_size"))
    aims = targets(sources, weights, repeats)
    count = aims.count()
    copies = "CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0L END"
    split = aims.selectExpr("*", f"{copies} AS copies").selectExpr("*", "target - CAST(copies * source_size AS DOUBLE) AS budget")
    cuts = thresholds(rows, split.select("source", "budget"), count).withColumnRenamed("source", "cut_source")
    plan = split.join(cuts, same("source", "cut_source"), "left").selectExpr("source AS own", "source_size", "target", "copies", "coalesce(threshold, 0L) AS threshold")
    taken = "size * (copies + CASE WHEN hash < threshold THEN 1L ELSE 0L END) AS taken"
    return by_source(rows, written(plan, "mix-plan"), count).selectExpr("doc_id", "size", "source_size", "target", taken)
