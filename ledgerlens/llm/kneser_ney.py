"""Quality classifier: interpolated modified Kneser-Ney character n-grams.

An n-gram is ``ORDER`` whole code points of 21 bits each: the last three in one
64-bit integer (gram), those before them in another (head), so the context is a
shift and the shorter n-gram a mask. Counts of trusted texts are added up over tasks; every
level's probabilities are joins of count tables dealt by n-gram, for exactly the
n-grams that the scored texts hold. Texts and the probabilities of their own
n-grams then meet part by part, which gives a perplexity for each document; a
document is good when it lies between two quantiles of the trusted texts of its
language.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow.fs import FileSelector
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.bitpack import as_uri, open_fs
from ledgerlens.llm.common import text_slices, written
from ledgerlens.session import scratch_path

ORDER = 5
BITS = 21
TAIL = 3  # characters in the column gram, those before are in head
OTHER = 1 << BITS  # above all symbols: no two characters share one
PAD = 1  # before each text, ORDER - 1 times
LOW, HIGH = 0.01, 0.97  # quantiles of trusted texts between which a document is good
SYMBOLS = 1 << BITS
CALIBRATION_SHARE = 4  # one trusted text of so many sets the quantiles, the others the model


Grams = tuple[np.ndarray, np.ndarray]  # (head, gram) of n-grams


def packed(symbols: list[np.ndarray]) -> Grams:
    """(head, gram) of n-grams, given as the symbols of each of their places."""
    out = [np.zeros(len(symbols[0]), np.uint64) for _ in range(2)]
    for k, own in enumerate(symbols):
        side = 0 if k < ORDER - TAIL else 1
        out[side] = (out[side] << np.uint64(BITS)) | own.astype(np.uint64)
    return out[0], out[1]


def codes(texts: list[str], places: bool = False) -> tuple[Grams, np.ndarray, np.ndarray]:
    """(distinct n-grams of all texts, their counts, bounds): one n-gram for each
    character, with its context. With ``places`` not the counts, but for each
    character the place of its n-gram among the distinct ones."""
    chars = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    bounds = np.cumsum([0, *map(len, chars)])
    pad = np.full(ORDER - 1, PAD, np.uint32)
    flat = np.concatenate([np.zeros(0, np.uint32), *(x for c in chars for x in (pad, c + np.uint32(2)))])
    at = np.flatnonzero(flat != PAD)
    used = np.flatnonzero(np.bincount(flat))
    bits = max(1, int(len(used) - 1).bit_length())
    unique = {"return_inverse": places, "return_counts": not places}
    if ORDER * bits <= 64:
        # Few different characters: their numbers fit one integer.
        number = np.zeros(int(flat.max(initial=0)) + 1, np.uint64)
        number[used] = np.arange(len(used), dtype=np.uint64)
        small, key = number[flat], np.zeros(len(at), np.uint64)
        for k in range(ORDER):
            key = (key << np.uint64(bits)) | small[at - (ORDER - 1 - k)]
        key, of = np.unique(key, **unique)
        mask = np.uint64((1 << bits) - 1)
        grams = packed([used[((key >> np.uint64(bits * (ORDER - 1 - k))) & mask).astype(np.int64)] for k in range(ORDER)])
    else:
        sides = [np.unique(x, return_inverse=True) for x in packed([flat[at - (ORDER - 1 - k)] for k in range(ORDER)])]
        key, of = np.unique((sides[0][1].astype(np.uint64) << np.uint64(32)) | sides[1][1].astype(np.uint64), **unique)
        grams = sides[0][0][(key >> np.uint64(32)).astype(np.int64)], sides[1][0][(key & np.uint64(0xFFFFFFFF)).astype(np.int64)]
    return grams, of, bounds


def added(parts: list[pa.Table]) -> pa.Table:
    """Tables (head, gram, n) as one with each n-gram once."""
    return pa.concat_tables(parts).group_by(["head", "gram"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["head", "gram", "n"])


def counted(texts: list[str]) -> pa.Table:
    (head, gram), n, _ = codes(texts)
    return pa.table({"head": head.view(np.int64), "gram": gram.view(np.int64), "n": n.astype(np.int64)})


def gram_counts(texts: DataFrame) -> DataFrame:
    """(head, gram, n) over all texts; tasks add up their own slices first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for lo, hi in text_slices(batch):
                held.append(counted(batch.column("text").slice(lo, hi - lo).to_pylist()))
                if sum(map(len, held)) > 2_000_000:
                    held[:] = [added(held)]
                    if len(held[0]) > 1_000_000:
                        yield from held[0].to_batches(max_chunksize=200_000)
                        held.clear()
        if held:
            yield from added(held).to_batches(max_chunksize=200_000)

    return texts.select("text").mapInArrow(count, "head long, gram long, n long").groupBy("head", "gram").agg(F.sum("n").alias("n"))


def shorter(k: int) -> list[str]:
    """SQL: head and gram of the n-gram of order k without its first character."""

    def low(column: str, chars: int) -> str:
        return f"({column} & {(1 << (BITS * chars)) - 1}L)"

    return [low("head", k - 1 - TAIL) if k - 1 > TAIL else "0L", "gram" if k - 1 >= TAIL else low("gram", k - 1)]


def lower_grams(grams: DataFrame, k: int) -> DataFrame:
    head, gram = shorter(k)
    return grams.selectExpr(f"{head} AS head", f"{gram} AS gram")


def discounts(counts: DataFrame) -> list[float]:
    """D1, D2, D3+ of one order, from its counts of counts."""
    n = [r or 0 for r in counts.selectExpr(*(f"count_if(n = {k})" for k in range(1, 5))).first()]
    if not n[0] or not n[1]:
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else (0.5, 0.75, 0.9)[k] for k in range(3)]
    return [min(max(d, 0.05), k + 1 - 0.05) for k, d in enumerate(raw)]


def train(texts: DataFrame) -> list[tuple[DataFrame, list[float]]]:
    """For each order 1 .. ORDER: (head, gram, n) and the discounts. The counts of the
    highest order are those of the texts, below they are numbers of different
    characters before an n-gram."""
    counts = written(gram_counts(texts), "ngram-counts")
    levels = [(counts, discounts(counts))]
    for k in range(ORDER, 1, -1):
        counts = written(lower_grams(counts, k).groupBy("head", "gram").agg(F.count("*").alias("n")), "ngram-counts")
        levels.append((counts, discounts(counts)))
    return levels[::-1]


def probabilities(grams: DataFrame, model: list[tuple[DataFrame, list[float]]]) -> DataFrame:
    """(head, gram, p) for the wanted n-grams (distinct, of the highest order):
    the interpolated probabilities, by joins with the counts of each order.
    Without a column head nothing known stands before gram."""
    wanted = [grams.select("head" if "head" in grams.columns else F.lit(0).cast("long").alias("head"), "gram")]
    for k in range(ORDER, 1, -1):
        wanted.append(lower_grams(wanted[-1], k).distinct())
    below: DataFrame | None = None
    for k, ((counts, (d1, d2, d3)), want) in enumerate(zip(model, wanted[::-1], strict=True), 1):
        context = counts.groupBy("head", F.expr(f"shiftright(gram, {BITS})").alias("context")).agg(
            F.sum("n").alias("total"),
            F.expr(f"{d1}D * count_if(n = 1) + {d2}D * count_if(n = 2) + {d3}D * count_if(n > 2)").alias("spare"),
        )
        lower_head, lower = shorter(k)
        rows = want.selectExpr("head", "gram", f"shiftright(gram, {BITS}) AS context", f"{lower_head} AS lower_head", f"{lower} AS lower")
        rows = rows.join(counts, ["head", "gram"], "left").join(context, ["head", "context"], "left")
        if below is None:
            rows = rows.withColumn("q", F.lit(1.0 / SYMBOLS))
        else:
            rows = rows.join(below.selectExpr("head AS lower_head", "gram AS lower", "p AS q"), ["lower_head", "lower"])
        own = f"greatest(0D, coalesce(n, 0) - CASE WHEN n = 1 THEN {d1}D WHEN n = 2 THEN {d2}D ELSE {d3}D END)"
        below = rows.selectExpr("head", "gram", f"CASE WHEN total IS NULL THEN q ELSE ({own} + spare * q) / total END AS p")
        if k < ORDER:
            below = written(below, "ngram-lower")
    return below


def pressed(head: np.ndarray, gram: np.ndarray) -> bytes:
    """Sorted n-grams, compressed: neighbours share most of their bytes."""
    return zstandard.ZstdCompressor(level=9).compress(head.astype("<i8").tobytes() + gram.astype("<i8").tobytes())


def unpressed(raw: bytes) -> np.ndarray:
    """The rows head and gram that ``pressed`` was given."""
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), "<i8").reshape(2, -1)


HELD = "part long, doc_ids array<string>, langs array<string>, sizes array<long>, body binary, grams binary"
HELD_ARROW = pa.schema(
    [("part", pa.int64()), ("doc_ids", pa.list_(pa.string())), ("langs", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64())),
     ("body", pa.binary()), ("grams", pa.binary())]
)


def held(docs: DataFrame) -> DataFrame:
    """The documents as compressed slices, under the number of the task that
    read them, and one row a task with the distinct n-grams of its texts, sorted
    (``pressed``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, press = TaskContext.get().partitionId(), [counted([])], zstandard.ZstdCompressor(level=9)
        for batch in batches:
            for lo, hi in text_slices(batch):
                own = batch.slice(lo, hi - lo)
                texts = [t or "" for t in own.column("text").to_pylist()]
                raw = [t.encode() for t in texts]
                seen.append(counted(texts))
                if sum(map(len, seen[1:])) > max(1_000_000, len(seen[0])):
                    seen[:] = [added(seen)]
                yield pa.RecordBatch.from_pylist(
                    [{"part": part, "doc_ids": own.column("doc_id").to_pylist(), "langs": own.column("lang").to_pylist(), "sizes": [len(r) for r in raw],
                      "body": press.compress(b"".join(raw)), "grams": None}], schema=HELD_ARROW)
        own = added(seen).sort_by([("head", "ascending"), ("gram", "ascending")])
        yield pa.RecordBatch.from_pylist([{"part": part, "grams": pressed(*(own.column(c).to_numpy() for c in ("head", "gram")))}], schema=HELD_ARROW)

    return docs.selectExpr("CAST(doc_id AS string) AS doc_id", "lang", "text").mapInArrow(run, HELD)


def perplexities(docs: DataFrame, model: list[tuple[DataFrame, list[float]]]) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity) of all documents (doc_id, text,
    lang); an empty text has perplexity null.

    Texts are held in slices where they were read, and stay there: the
    sorted n-grams of a part and their probabilities are gathered, compressed, into
    one file of the shared folder, which the tasks that score its slices read."""
    texts = written(held(docs), "ngram-texts")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("grams").to_pylist(), strict=True):
                head, gram = unpressed(raw)
                for lo in range(0, len(gram), 200_000):
                    some = [pa.array(x[lo : lo + 200_000]) for x in (head, gram)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some[0]), part)), *some], names=["part", "head", "gram"])

    by_part = texts.filter("grams IS NOT NULL").select("part", "grams").mapInArrow(spread, "part long, head long, gram long")
    known = written(probabilities(by_part.select("head", "gram").distinct(), model), "ngram-probabilities")
    folder = as_uri(scratch_path(docs.sparkSession, "ngram-parts"))

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        part, (head, gram) = int(pdf["part"].iloc[0]), (pdf[c].to_numpy() for c in ("head", "gram"))
        order = np.lexsort((gram, head))
        grams, log = pressed(head[order], gram[order]), np.log(pdf["p"].to_numpy()[order]).astype("<f8")
        store, base = open_fs(folder)
        # Every attempt leaves a file of its own, all with the same content, which
        # gets its place when it is whole.
        name = uuid.uuid4().hex[:12]
        for place in ("writing", str(part)):
            store.create_dir(f"{base}/{place}", recursive=True)
        with store.open_output_stream(f"{base}/writing/{part}-{name}") as out:
            out.write(np.array([len(grams)], "<i8").tobytes())
            out.write(grams)
            out.write(zstandard.ZstdCompressor(level=3).compress(log.tobytes()))
        store.move(f"{base}/writing/{part}-{name}", f"{base}/{part}/{name}")
        return pd.DataFrame({"part": [part], "n": [len(log)]})

    by_part.join(known, ["head", "gram"]).groupBy("part").applyInPandas(gather, "part long, n long").write.format("noop").mode("overwrite").save()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, heads, grams, keys, log = None, *np.zeros((2, 0), np.uint64), np.zeros(0, np.int64), np.zeros(0)
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != have and sum(row["sizes"]):
                    store, base = open_fs(folder)
                    file = store.get_file_info(FileSelector(f"{base}/{row['part']}"))[0]
                    with store.open_input_file(file.path) as stream:
                        raw = stream.read()
                    size = np.frombuffer(raw, "<i8", 1)[0]
                    # Heads and grams by number: a pair of numbers is the key of an
                    # n-gram, and keys come in the order of the n-grams.
                    (heads, high), (grams, low) = (np.unique(x.view(np.uint64), return_inverse=True) for x in unpressed(raw[8 : 8 + size]))
                    keys, log = (high.astype(np.int64) << 32) | low.astype(np.int64), np.frombuffer(press.decompress(raw[8 + size :]), "<f8")
                    have = row["part"]
                body, ends = press.decompress(row["body"]), np.cumsum([0, *row["sizes"]])
                (head, gram), of, bounds = codes([body[a:b].decode() for a, b in zip(ends[:-1], ends[1:], strict=True)], places=True)
                key = (np.searchsorted(heads, head) << 32) | np.searchsorted(grams, gram)
                total = np.concatenate([[0.0], np.cumsum(log[np.searchsorted(keys, key)][of])]) if len(of) else np.zeros(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.string()), pa.array(row["langs"], pa.string()), pa.array(np.diff(bounds)), pa.array(total[bounds[1:]] - total[bounds[:-1]])],
                    names=["doc_id", "lang", "n_chars", "log"],
                )

    # Slices of one part are read in order, so a task opens few files.
    scored = texts.filter("grams IS NULL").select("part", "doc_ids", "langs", "sizes", "body").mapInArrow(
        score, "doc_id string, lang string, n_chars long, log double"
    )
    return scored.selectExpr("CAST(doc_id AS long) AS doc_id", "lang", "n_chars", "CASE WHEN n_chars > 0 THEN exp(-log / n_chars) END AS perplexity")


def held_out(doc_id: str = "doc_id") -> str:
    return f"(crc32(CAST(CAST({doc_id} AS string) AS binary)) % 3 = 1)"


def classify(docs: DataFrame, labels: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Perplexity and predicted quality (1: good) of all documents (doc_id,
    text, lang). Trusted texts are those labelled quality 1 that are not held
    out (crc32 of the id mod 3 is 1); by a hash of the id, three of four train
    the model and the others give the quantiles.

    Returns doc_id, lang, held_out, n_chars, perplexity, predicted. A null or
    empty text has no perplexity and is not good; languages without trusted
    texts (null too) take the quantiles over all languages; without any trusted
    text nothing is good. Rows may repeat."""
    docs = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text", "CAST(lang AS string) AS lang")
    good = labels.selectExpr("CAST(doc_id AS long) AS doc_id", "quality").filter(f"quality = 1 AND NOT {held_out()}").select("doc_id").distinct()
    # Texts that set the quantiles are not those that the model has seen.
    seen = f"pmod(xxhash64(doc_id), {CALIBRATION_SHARE}) <> 0"
    # The filters leave out before the join what no trusted id can match.
    model = train(docs.filter(f"text IS NOT NULL AND {seen} AND NOT {held_out()}").join(good, "doc_id", "left_semi"))
    scored = written(perplexities(docs, model), "ngram-scored")
    trusted = scored.filter(f"perplexity IS NOT NULL AND NOT ({seen})").join(good, "doc_id", "left_semi")
    cut = f"percentile_approx(perplexity, array({low}, {high}), 10000) AS q"
    by_lang = trusted.filter("lang IS NOT NULL").groupBy("lang").agg(F.expr(cut)).withColumnRenamed("lang", "_lang")
    every = trusted.selectExpr(cut).first()["q"] or [math.inf, -math.inf]
    lowest, highest = (f"coalesce(q[{k}], double('{v}'))" for k, v in enumerate(every))
    return scored.join(by_lang, F.col("lang") == F.col("_lang"), "left").selectExpr(
        "doc_id", "lang", f"coalesce({held_out()}, false) AS held_out", "n_chars", "perplexity",
        f"CASE WHEN perplexity BETWEEN {lowest} AND {highest} THEN 1 ELSE 0 END AS predicted",
    )
