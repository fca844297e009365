"""Secret scan: base patterns, and character Markov models that add spans.

Two first-order character models, one of random strings and one of ordinary
identifiers and words, are trained on the scanned corpus itself: what the base
patterns match is a labelled sample of random strings, all other text is one of
ordinary words. A character's chance is that of its class (lower, upper, digit,
sign, edge) after the class before, times its own in that class. For words the latter
comes from pairs of letters whatever their case, backing off to single
letters, and the classes follow the styles that identifiers are written in (lower,
UPPER, Title, camelCase, with signs or numbers between), so that capitals and
signs a corpus of prose never shows are not taken for random. Base matches are cut out of
a run, and what is left of it is judged by the sum of the log-likelihood ratios
of its characters, random against ordinary: a long part with a large sum is added
as a ``random`` span; of other parts every long maximal-scoring stretch with a
large sum is, out to the next ``/_=-`` if that is near.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.common import flat_bytes, text_slices

# The base patterns and least lengths.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
RUN_CHARS = 16  # shorter runs are not candidates for the models
LEAST_RATIO = 12.0  # natural logarithm: the odds against a secret that a long run has to overcome
SEPARATORS = "/_=-"  # a stretch of a run goes on to the next of these
PSEUDO_COUNT = 0.5
SINGLE = 0.4  # weight of single letters beside pairs: a corpus has few of the words that names are made of
SAMPLED = 0.5  # weight of the labelled random strings; the rest is uniform over letters and digits
REPEATED = 0.1  # chance that ordinary text repeats a character, as rules do

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(SYMBOLS) + 1  # symbol 0 is anything else: the edge of a run
_CODE = np.zeros(256, np.int64)
_CODE[[ord(c) for c in SYMBOLS]] = np.arange(1, SIZE)
# Classes of the symbols: edge, upper, lower, digit, sign; and letters whatever their case (0: none).
EDGE, UPPER, LOWER, DIGIT, SIGN = range(5)
CLASS = np.repeat([EDGE, UPPER, LOWER, DIGIT, SIGN], [1, 26, 26, 10, len(SYMBOLS) - 62])
LETTER = np.r_[0, 1:27, 1:27, np.zeros(len(SYMBOLS) - 52, np.int64)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base matches, code points, in order."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text) if len(m[0]) >= HEX_CHARS]
    return sorted(out, key=lambda s: (s[0], s[2]))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def long_run_rows(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts hold a run of ``RUN_CHARS`` symbols or more; runs end with their text."""
    inside = _CODE[raw] > 0
    begins, ends = inside & np.r_[True, ~inside[:-1]][: len(raw)], inside & np.r_[~inside[1:], True][: len(raw)]
    lo, hi = bounds[:-1][np.diff(bounds) > 0], bounds[1:][np.diff(bounds) > 0] - 1
    begins[lo], ends[hi] = inside[lo], inside[hi]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    found = np.zeros(len(bounds) - 1, bool)
    found[np.searchsorted(bounds, start[end - start >= RUN_CHARS], side="right") - 1] = True
    return found


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], list[list], np.ndarray, np.ndarray]]:
    """(first row, texts, base spans, texts with long runs, bytes) of the slices
    of a batch."""
    for lo, hi in text_slices(batch):
        column = batch.column("text").slice(lo, hi - lo)
        raw, bounds = flat_bytes(column)
        runs = long_run_rows(raw, bounds)
        texts = [t or "" for t in column.to_pylist()]
        spans = []
        for t, long in zip(texts, runs, strict=True):
            if long or any(k in t.lower() for k in KEYWORDS):
                spans.append(base_spans(t))
            else:
                spans.append([])
        yield lo, texts, spans, runs, raw


def _bigrams(codes: np.ndarray) -> np.ndarray:
    """Counts of neighbouring symbols, run edges included."""
    codes = np.concatenate([[0], codes, [0]])
    both = codes[:-1] * SIZE + codes[1:]
    counts = np.bincount(both, minlength=SIZE * SIZE)
    counts[0] = 0
    return counts


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratios (random against ordinary) of symbol pairs, from
    all texts. The driver receives two fixed-size tables of counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SIZE * SIZE), np.int64)
        for batch in batches:
            for _, texts, spans, _, raw in _texts(batch):
                for lo in range(0, len(raw), 1 << 20):
                    total[1] += _bigrams(_CODE[raw[lo : lo + (1 << 20)]])
                for text, own in zip(texts, spans, strict=True):
                    for a, b, kind in own:
                        value = ASSIGN.match(text, a)[2] if kind == 0 else text[a:b]
                        got = _bigrams(_CODE[np.frombuffer(value.encode(), np.uint8)])
                        total[0] += got
                        total[1] -= got
        model, pair = np.nonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"model": pa.array(model, pa.int32()), "pair": pa.array(pair, pa.int32()), "n": pa.array(total[model, pair], pa.int64())}
        )

    rows = docs.select("text").mapInArrow(count, "model int, pair int, n long").groupBy("model", "pair").sum("n").collect()
    counts = np.zeros((2, SIZE, SIZE))
    for model, pair, n in rows:
        counts[model, pair // SIZE, pair % SIZE] = max(n, 0)
    ratio = np.log(random_model(counts[0])) - np.log(ordinary_model(counts[1]))
    ratio[:, 0] = 0.0  # where a run ends says nothing
    return ratio


def random_model(counts: np.ndarray) -> np.ndarray:
    """Chances of a symbol after another in random strings, from counts of pairs
    in labelled ones: classes as sampled, any character of a class alike; mixed with
    strings of letters and digits that are all alike."""
    sizes = np.bincount(CLASS, minlength=5)
    free = sizes * (np.arange(5) != EDGE)
    free[SIGN] = 1  # one sign for 62 letters and digits
    classes = np.zeros((5, 5))
    np.add.at(classes, (CLASS[:, None], CLASS[None, :]), counts)
    classes[:, EDGE] = 0.0
    classes = (classes + PSEUDO_COUNT * free) / (classes + PSEUDO_COUNT * free).sum(axis=1, keepdims=True)
    mixed = SAMPLED * classes + (1 - SAMPLED) * free / free.sum()
    return np.where(CLASS == EDGE, 1.0, (mixed / sizes)[CLASS][:, CLASS])


def ordinary_model(counts: np.ndarray) -> np.ndarray:
    """Chances of a symbol after another in ordinary text, from counts of pairs
    in prose: letters by pairs, whatever their case (first letters of words by
    themselves), and the classes of identifiers in all styles."""
    letters = np.zeros((27, 27))
    np.add.at(letters, (LETTER[:, None], LETTER[None, :]), counts)
    letters[:, 0] = 0.0
    single = letters[1:].sum(axis=0) + PSEUDO_COUNT
    single[0] = 0.0
    single /= single.sum()
    letters = SINGLE * single + (1 - SINGLE) * (letters + single) / (letters.sum(axis=1, keepdims=True) + 1)
    words = max(float(counts[LETTER == 0][:, LETTER > 0].sum()), 1.0)
    inner = max(float(counts[LETTER > 0][:, LETTER > 0].sum()) / words, 2.0)  # pairs of letters a word
    # Fixed shares of styles: a third of all words each in lower, UPPER and Title;
    # what follows a word is an edge, a sign, the next word or a number.
    #                 edge, upper, lower, digit, sign
    styles = np.array([
        [0.00, 0.35, 0.50, 0.08, 0.07],
        [0.50, inner, 1.02, 0.06, 0.42],
        [0.80, 0.50, 2 * inner - 1, 0.10, 0.60],
        [0.20, 0.05, 0.05, 0.50, 0.20],
        [0.02, 0.30, 0.55, 0.10, 0.03],
    ])
    styles /= styles.sum(axis=1, keepdims=True)
    own = np.array([0.0, 0.0, 0.0, 1 / 10, 1 / (SIZE - 63)])[CLASS]
    within = np.where(LETTER > 0, letters[LETTER][:, LETTER], own)
    chance = styles[CLASS][:, CLASS] * within
    chance[1:] = (1 - REPEATED) * chance[1:] + REPEATED * np.eye(SIZE)[1:]
    return np.where(CLASS == EDGE, 1.0, chance)


def stretches(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring stretches (start, end, sum) of scores, from the left:
    the best one, then those of what is left on either side of it. One linear
    scan (Ruzzo-Tompa)."""
    held: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum up to the end
    links: list[int] = []  # for each the last one before whose sum before is less
    total = 0.0
    for k, x in enumerate(scores):
        before, total = total, total + x
        if x <= 0:
            continue
        own = (k, k + 1, before, total)
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= own[2]:
                j = links[j]
            if j < 0 or held[j][3] >= own[3]:
                held.append(own)
                links.append(j)
                break
            own = (held[j][0], k + 1, held[j][2], own[3])
            del held[j:], links[j:]
    return [(a, b, up - low) for a, b, low, up in held]


def uncovered(start: int, end: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of start .. end outside the base spans (sorted by start)."""
    for a, b, _ in base:
        if b <= start or a >= end:
            continue
        if a > start:
            yield start, a
        start = max(start, b)
    if start < end:
        yield start, end


def _part_spans(text: str, a: int, b: int, ratio: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Spans of one part of a run: all of it, or its stretches."""
    if b - a < RUN_CHARS:
        return
    codes = np.concatenate([[0], _CODE[np.frombuffer(text[a:b].encode(), np.uint8)], [0]])
    steps = ratio[codes[:-1], codes[1:]]
    if steps.sum() >= LEAST_RATIO:
        yield a, b, 3
    elif steps[steps > 0].sum() >= LEAST_RATIO:
        # The last pair, of a character and the edge, counts for its character.
        scores = steps[:-1].tolist()
        scores[-1] += steps[-1]
        end = a
        for x, y, total in stretches(scores):
            if total < LEAST_RATIO or y - x < RUN_CHARS or a + y <= end:
                continue
            before = max([a, *(text.rfind(c, a, a + x + 1) + 1 for c in SEPARATORS)])
            after = min([b, *(k for k in (text.find(c, a + y - 1, b) for c in SEPARATORS) if k >= 0)])
            start = max(end, before if a + x - before < RUN_CHARS else a + x)
            end = after if after - (a + y) < RUN_CHARS else a + y
            yield start, end, 3


def random_spans(text: str, base: list[tuple[int, int, int]], ratio: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of the long runs outside the base spans."""
    out = []
    for m in RUN.finditer(text):
        if m.end() - m.start() >= RUN_CHARS and not any(a < m.end() and m.start() < b for a, b, _ in base):
            out += _part_spans(text, m.start(), m.end(), ratio)
    return out


def rest_spans(text: str, base: list[tuple[int, int, int]], ratio: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of what base spans leave of the long runs that they overlap."""
    out = []
    for m in RUN.finditer(text) if base else ():
        if m.end() - m.start() >= RUN_CHARS and (own := [s for s in base if s[0] < m.end() and m.start() < s[1]]):
            for a, b in uncovered(m.start(), m.end(), own):
                out += _part_spans(text, a, b, ratio)
    return out


def added_spans(text: str, base: list[tuple[int, int, int]], ratio: np.ndarray) -> list[tuple[int, int, int]]:
    """All spans that the models add to the base spans."""
    return [*random_spans(text, base, ratio), *rest_spans(text, base, ratio)]


FOUND = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"


def scan(docs: DataFrame, ratio: np.ndarray | None = None) -> DataFrame:
    """Secrets of every document (doc_id, text; other columns are ignored).

    One row a row of ``docs``: counts by kind, the digest of the base spans and
    all spans as ``kind:start:end`` by start, then kind. A null or empty text
    has none; a null doc_id stays null; repeated rows are rows of their own.
    """
    ratio = train(docs) if ratio is None else ratio

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts, base, runs, _ in _texts(batch):
                rows = []
                for text, own, long in zip(texts, base, runs, strict=True):
                    added = added_spans(text, own, ratio) if long else []
                    kinds = [k for _, _, k in own]
                    rows.append((
                        *(kinds.count(k) for k in range(3)), len(added), hashlib.sha256(joined(own).encode()).hexdigest(),
                        joined(sorted([*own, *added], key=lambda s: (s[0], s[2]))),
                    ))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, len(texts))]
                    + [pa.array(c, pa.int64()) for c in cols[:4]]
                    + [pa.array(c, pa.string()) for c in cols[4:]],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"],
                )

    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(find, FOUND)


def redact(docs: DataFrame, ratio: np.ndarray | None = None, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask`` (overlapping spans by
    one mask); n_chars, if there, follows the new text. All rows stay."""
    ratio = train(docs) if ratio is None else ratio
    schema = docs.schema

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str | None] = []
            for lo, texts, base, runs, _ in _texts(batch):
                for i, (text, own, long) in enumerate(zip(texts, base, runs, strict=True)):
                    spans = sorted([*own, *(added_spans(text, own, ratio) if long else [])])
                    if not spans:
                        out.append(batch.column("text")[lo + i].as_py())
                        continue
                    parts, at = [], 0
                    for a, b, _ in spans:
                        if a >= at:
                            parts += [text[at:a], mask]
                        at = max(at, b)
                    out.append("".join([*parts, text[at:]]))
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["text"] = pa.array(out, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in out], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    kept = docs.withColumn("n_chars", docs["n_chars"].cast("long")) if "n_chars" in docs.columns else docs
    return kept.mapInArrow(clean, kept.schema if "n_chars" in docs.columns else schema)
