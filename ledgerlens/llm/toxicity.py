"""Toxicity by maximum-scoring segments.

Words get log-odds (toxic against clean) with informative Dirichlet priors: the
prior of a word is its share of all training texts, so rare words stay near 0
and only significant ones score. A word that is not significant itself takes
the score of its longest significant prefix (unseen forms of a toxic stem). All
other words cost a small constant, so expected scores are negative. One linear
scan of a text finds every maximal-scoring segment; the scores of its best
segments are judged together by the extreme-value distribution of the best
segment scores of clean training texts; the probability that a clean text does
as well, set against how toxic training texts do, becomes the posterior
probability of label 1.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.llm.common import text_slices, written

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (8, 7, 6, 5, 4)  # lengths of the stems tried when a word is not significant
STEM_SHARE = 0.6  # a stem is dropped when one significant word makes up more of its toxic texts
PRIOR_SHARE = 0.1  # weight of the Dirichlet prior, as a share of the toxic texts' word types
CAUTION = 0.5  # standard errors that are taken off a log-odds
LEAST_TEXTS = 3  # toxic training texts that a feature needs
MODEL_FEATURES = 100_000  # bound of the shared model: the most significant features
DRIFT = 0.05  # what any other word costs
SEGMENTS = 8  # best segments of a text that are judged together
THRESHOLD = 0.7
QUANTILES = 64  # of the evidence of toxic training texts
LAMBDAS = [round(0.2 + 0.05 * k, 2) for k in range(27)]  # grid of the scale of the extreme-value law


def held_out(doc_id: str = "doc_id") -> str:
    """SQL: rows that no label is learned from."""
    return f"(crc32(CAST(CAST({doc_id} AS string) AS binary)) % 3 = 1)"


def features(text: str) -> set[str]:
    """Distinct words of a text, and their prefixes marked with ``*``."""
    words = set(WORD.findall(text.lower()))
    return words.union(*({w[:k] + "*" for w in words if len(w) > k} for k in PREFIXES))


def feature_counts(train: DataFrame) -> DataFrame:
    """Texts of each class that hold a feature, from (text, toxic) rows.

    Tasks add up their own rows first. The empty feature counts texts, ``#`` the
    features of all texts together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_pydict(
                {"feature": pa.array(names, pa.string()), **{c: pa.array([n[x] for x in names], pa.int64()) for c, n in zip(("clean", "toxic"), seen, strict=True)}}
            )
            for n in seen:
                n.clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                found = features(text or "")
                seen[toxic].update(found)
                seen[toxic][""] += 1
                seen[toxic]["#"] += len(found)
            if len(seen[0]) + len(seen[1]) > 400_000:
                yield rows()
        yield rows()

    return train.select("text", "toxic").mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )


def log_odds(counts: DataFrame) -> tuple[dict[str, float], float]:
    """Significant features with their log-odds, and the share of toxic texts.

    The model is bounded (``MODEL_FEATURES``), so it can be sent to all tasks."""
    marks = {r.feature: (r.clean, r.toxic) for r in counts.filter("feature IN ('', '#')").collect()}
    (texts0, texts1), (n0, n1) = marks.get("", (0, 0)), marks.get("#", (0, 0))
    if not texts1 or not texts0:
        return {}, 0.0 if not texts1 else 1.0
    weight, toxic_share = PRIOR_SHARE * n1, texts1 / (texts0 + texts1)
    prior = f"({weight!r}D * (clean + toxic) / {float(n0 + n1)})"

    def side(count: str, total: int) -> str:
        return f"ln(({count} + prior) / ({total + weight!r}D - {count} - prior))"

    # Log-likelihood ratio of the feature's own share of toxic texts against
    # the common one. A feature is significant when it is larger than the
    # logarithm of the number of features tested.
    ratio = f"toxic * ln(toxic / ((clean + toxic) * {toxic_share!r}D)) + IF(clean > 0, clean * ln(clean / ((clean + toxic) * {1 - toxic_share!r}D)), 0D)"
    tested = counts.filter(f"feature NOT IN ('', '#') AND toxic >= {LEAST_TEXTS}")
    bound = math.log(max(2, tested.count()))
    best = (
        tested.filter(f"toxic > (clean + toxic) * {toxic_share!r}D AND {ratio} >= {bound!r}D")
        .selectExpr("feature", "clean", "toxic", f"{prior} AS prior", f"{ratio} AS ratio")
        .selectExpr("feature", "ratio", "toxic", f"{side('toxic', n1)} - {side('clean', n0)} - {CAUTION} * sqrt(1 / (toxic + prior) + 1 / (clean + prior)) AS odds")
        .filter(f"odds > {2 * DRIFT}")
        .orderBy(F.col("ratio").desc(), "feature")
        .limit(MODEL_FEATURES)
    )
    rows = {r.feature: (float(r.odds), r.toxic) for r in best.collect()}
    most: dict[str, int] = {}
    for word, (_, n) in rows.items():
        for k in PREFIXES:
            if not word.endswith("*") and len(word) > k:
                most[word[:k] + "*"] = max(n, most.get(word[:k] + "*", 0))
    return {f: odds for f, (odds, n) in rows.items() if most.get(f, 0) <= STEM_SHARE * n}, toxic_share


def word_score(word: str, model: dict[str, float]) -> float:
    """Log-odds of a word: its own, or of its longest significant prefix."""
    found = model.get(word)
    if found is None:
        for k in PREFIXES:
            if len(word) > k and (found := model.get(word[:k] + "*")) is not None:
                break
    return found - DRIFT if found is not None else -DRIFT


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, start, end) of a score sequence, in
    order: the linear scan of Ruzzo and Tompa over the positive scores only."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # [sum before, sum after, start, end, earlier candidate with a smaller sum before]
    for i in np.flatnonzero(scores > 0):
        left, right, start = float(sums[i]), float(sums[i + 1]), int(i)
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j = found[j][4]
            if j < 0 or found[j][1] >= right:
                found.append([left, right, start, int(i) + 1, j])
                break
            left, start = found[j][0], found[j][2]
            del found[j:]
    return [(r - a, s, e) for a, r, s, e, _ in found]


STATS = "_tox_words long, _tox_best array<double>, _tox_passages string"


def with_segments(docs: DataFrame, model: dict[str, float]) -> DataFrame:
    """All columns of ``docs``, and of every whole text the number of words, the
    scores of the best segments (largest first) and all segments
    (score:first word:end word)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            for lo, hi in text_slices(batch):
                part = batch.slice(lo, hi - lo)
                n_words, best, passages = [], [], []
                for text in part.column("text").to_pylist():
                    words = WORD.findall((text or "").lower())
                    n_words.append(len(words))
                    for w in set(words):
                        if w not in known:
                            known[w] = word_score(w, model)
                    scores = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
                    own = segments(scores)
                    best.append(sorted((s for s, _, _ in own), reverse=True)[:SEGMENTS])
                    passages.append(",".join(f"{s:.3f}:{a}:{b}" for s, a, b in own))
                if len(known) > 300_000:
                    known.clear()
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n_words, pa.int64()), pa.array(best, pa.list_(pa.float64())), pa.array(passages, pa.string())],
                    names=[*part.schema.names, "_tox_words", "_tox_best", "_tox_passages"],
                )

    return docs.mapInArrow(scan, StructType([*docs.schema.fields, *StructType.fromDDL(STATS).fields]))


def fit_extremes(clean: DataFrame) -> tuple[float, float]:
    """(lambda, ln K) of the law P(best >= s) = 1 - exp(-K n e^(-lambda s)),
    by maximum likelihood over a grid, from the segments of clean texts."""
    sums = clean.filter("_tox_words > 0").selectExpr("double(_tox_words) AS n", "coalesce(get(_tox_best, 0), 0D) AS s").selectExpr(
        "count(1) AS c", "sum(s) AS total", *[f"sum(n * exp(-{v} * s)) AS e{k}" for k, v in enumerate(LAMBDAS)]
    ).first()
    if not sums["c"]:
        return 1.0, 0.0
    c = sums["c"]
    gains = [c * math.log(v) - c * math.log(sums[f"e{k}"]) - v * sums["total"] for k, v in enumerate(LAMBDAS)]
    k = max(range(len(LAMBDAS)), key=gains.__getitem__)
    # Scores are log-odds, whose natural scale is 1: the fit may only lower it.
    if LAMBDAS[k] > 1:
        k = LAMBDAS.index(1.0)
    return LAMBDAS[k], math.log(c / sums[f"e{k}"])


def evidence(scale: float, log_k: float) -> str:
    """SQL: minus the logarithm of the chance that a clean text does as well,
    from the segments.

    With x_i = lambda s_i - ln(K n), r segments together are as good by chance
    with probability min over r of e^(-y) y^(r-1) / (r! (r-1)!), y = x_1 + ... +
    x_r (1 - exp(-e^(-x)) for one); the least of these, times the number tried,
    is the chance of a clean text."""
    x = f"transform(_tox_best, s -> {scale!r}D * s - ({log_k!r}D + ln(double(_tox_words))))"
    good = f"filter({x}, v -> v > 0)"
    one = f"CASE WHEN size(_tox_best) > 0 THEN -expm1(-exp(-least(greatest(get({x}, 0), -30D), 700D))) ELSE 1D END"
    tails = (
        f"transform(sequence(1, {SEGMENTS}), r -> CASE WHEN r > size({good}) OR r = 1 THEN 1D ELSE exp(least(0D,"
        f" -aggregate(slice({good}, 1, r), 0D, (a, v) -> a + v)"
        f" + (r - 1) * ln(aggregate(slice({good}, 1, r), 0D, (a, v) -> a + v))"
        f" - ln(double(factorial(r))) - ln(double(factorial(r - 1))))) * greatest(1, least({SEGMENTS}, size({good}))) END)"
    )
    p = f"least(1D, {one}, array_min({tails}))"
    return f"CASE WHEN _tox_words > 0 THEN -ln(greatest({p}, 1e-300D)) ELSE 0D END"


def probability(share: float, toxic_evidence: list[float]) -> str:
    """SQL: the posterior of label 1 from the column _tox_evidence, e.

    Clean texts reach e with chance exp(-e), toxic ones stay at or below it
    with the share q of the quantiles of their training texts; the posterior is
    share q / (share q + (1 - share) exp(-e))."""
    known = ", ".join(f"{v!r}D" for v in toxic_evidence)
    q = f"((0.5D + size(filter(CAST(array({known}) AS array<double>), v -> v <= _tox_evidence))) / {len(toxic_evidence) + 1}D)"
    return f"{share!r}D * {q} / ({share!r}D * {q} + {1 - share!r}D * exp(-_tox_evidence))" if share < 1 else "1D"


class Model(NamedTuple):
    words: dict[str, float]  # log-odds of significant words, and stems marked with *
    share: float  # of toxic training texts
    scale: float  # of the extreme-value law
    log_k: float
    quantiles: list[float]  # of the evidence of toxic training texts


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id,
    toxic) marks and that are not held out. Exact copies count once; a document
    with several labels is toxic if one says so; null labels, ids and texts
    train nothing."""
    docs = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").filter(f"doc_id IS NOT NULL AND text IS NOT NULL AND NOT {held_out()}")
    mark = (
        labels.selectExpr("CAST(doc_id AS long) AS doc_id", "CAST(toxic AS int) AS toxic")
        .filter(f"doc_id IS NOT NULL AND toxic IN (0, 1) AND NOT {held_out()}")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # One document of each group of exact copies; the labels meet hashes first, texts after.
    first = (
        docs.selectExpr("doc_id", "xxhash64(text) AS copy")
        .join(mark, "doc_id")
        .groupBy("copy")
        .agg(F.expr("min(struct(-toxic AS toxic, doc_id))").alias("one"))
        .selectExpr("one.doc_id", "-one.toxic AS toxic")
    )
    train = written(docs.join(first, "doc_id").select("text", "toxic"), "toxic-train")
    words, share = log_odds(written(feature_counts(train), "toxic-counts"))
    found = written(with_segments(train, words).drop("text"), "toxic-segments")
    scale, log_k = fit_extremes(found.filter("toxic = 0"))
    cuts = found.filter("toxic = 1").selectExpr(
        f"percentile_approx({evidence(scale, log_k)}, array({', '.join(str(k / QUANTILES) for k in range(QUANTILES + 1))})) AS q"
    ).first()["q"]
    return Model(words, share, scale, log_k, cuts or [])


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with _tox_score, _tox_words, _tox_passages."""
    return (
        with_segments(docs, model.words)
        .withColumn("_tox_evidence", F.expr(evidence(model.scale, model.log_k)))
        .withColumn("_tox_score", F.expr(probability(model.share, model.quantiles)))
        .drop("_tox_best", "_tox_evidence")
    )


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score all documents (doc_id, text; other columns are ignored).

    Returns doc_id, held_out, score (0 to 1), predicted, n_words, passages (score:first
    word:end word of every maximal segment). Null or empty texts, and texts
    without words, score as a text without any toxic word. Without labels of
    both classes every score is the share of toxic ones (0 or 1). Repeated rows
    are scored each, null ids too.
    """
    own = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text")
    return with_score(own, fit(docs, labels)).selectExpr(
        "doc_id", f"coalesce({held_out()}, false) AS held_out", "_tox_score AS score",
        f"CASE WHEN _tox_score >= {threshold}D THEN 1 ELSE 0 END AS predicted", "_tox_words AS n_words", "_tox_passages AS passages",
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, unchanged, that score below the threshold."""
    return with_score(docs, fit(docs, labels)).filter(f"_tox_score < {threshold}D").select(*docs.columns)
