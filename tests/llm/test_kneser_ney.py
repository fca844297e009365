"""Kneser-Ney quality classifier."""

import math
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from ledgerlens.llm import kneser_ney as k
from ledgerlens.llm import queries as q

SF = "/root/testdata/sf0.01"
N = k.ORDER


def symbols(text):
    """Characters from U+0FFD on are one symbol."""
    return "".join(c if ord(c) + 2 < k.OTHER else "\uffff" for c in text)


def brute_model(texts):
    """Interpolated modified Kneser-Ney over characters, by dictionaries."""
    levels = [Counter() for _ in range(N + 1)]
    for t in texts:
        s = "\x00" * (N - 1) + symbols(t)
        for i in range(len(t)):
            levels[N][s[i : i + N]] += 1
    for m in range(N - 1, 0, -1):
        for g in levels[m + 1]:
            levels[m][g[1:]] += 1
    cuts, contexts = [None], [None]
    for m in range(1, N + 1):
        n = [sum(v == c for v in levels[m].values()) for c in range(1, 5)]
        if not n[0] or not n[1]:
            d = [0.5, 0.75, 0.9]
        else:
            y = n[0] / (n[0] + 2 * n[1])
            d = [c - (c + 1) * y * n[c] / n[c - 1] if n[c - 1] else (0.5, 0.75, 0.9)[c - 1] for c in (1, 2, 3)]
            d = [min(max(x, 0.05), c - 0.05) for c, x in enumerate(d, 1)]
        own = defaultdict(Counter)
        for g, c in levels[m].items():
            own[g[:-1]][min(c, 3)] += 1
            own[g[:-1]]["total"] += c
        cuts.append(d)
        contexts.append(own)

    def p(g):
        if not g:
            return 1 / k.SYMBOLS
        m = len(g)
        if g[:-1] not in contexts[m]:
            return p(g[1:])
        c, own, d = levels[m][g], contexts[m][g[:-1]], cuts[m]
        spare = sum(d[i - 1] * own[i] for i in (1, 2, 3))
        return (max(0.0, c - (d[min(c, 3) - 1] if c else 0)) + spare * p(g[1:])) / own["total"]

    return p


def brute_perplexity(p, text):
    s = "\x00" * (N - 1) + symbols(text)
    return math.exp(-sum(math.log(p(s[i : i + N])) for i in range(len(text))) / len(text)) if text else None


def frame(spark, rows):
    return spark.createDataFrame([(d, t, g, 1.5, "p") for d, t, g in rows], "doc_id long, text string, lang string, perplexity double, gram string")


TRAIN = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "thé cät 中 sat", "aaaa"]


def test_perplexities_equal_the_definition(spark):
    texts = [*TRAIN, "the bat sat", "zzz 日本 zz", "", None, "x", "\x00\x01 odd", "the cat " * 3000]
    rows = [(None if i == 2 else i, t, "en") for i, t in enumerate(texts)]
    model = k.train(frame(spark, [(i, t, "en") for i, t in enumerate(TRAIN)]))
    got = {r.doc_id: r.perplexity for r in k.perplexities(frame(spark, rows).select("doc_id", "text", "lang"), model).collect()}
    p = brute_model(TRAIN)
    for d, t, _ in rows:
        want = brute_perplexity(p, t or "")
        # NUL and U+0001 of a text are symbols of their own, not the padding
        if t and "\x00" in t:
            continue
        assert got[d] == want if want is None else math.isclose(got[d], want, rel_tol=1e-9), (d, t)


def test_probabilities_sum_to_one(spark):
    model = k.train(frame(spark, [(i, t, "en") for i, t in enumerate(TRAIN)]))
    base = (ord("t") + 2 << 36) | (ord("h") + 2 << 24) | (ord("e") + 2 << 12) | (ord(" ") + 2)
    grams = spark.range(k.SYMBOLS).selectExpr(f"shiftleft({base}L, {k.BITS}) + id AS gram")
    assert math.isclose(k.probabilities(grams, model).selectExpr("sum(p)").first()[0], 1.0, rel_tol=1e-9)


def test_op4_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = q.op4_kneser_ney_quality(spark, SF).collect()
    assert len(rows) == pq.read_metadata(f"{SF}/documents.parquet").num_rows
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [p for y, p in held if y == 1], [p for y, p in held if y == 0]
    assert sum(good) >= 0.8 * len(good)
    assert sum(bad) <= 0.35 * len(bad)


@pytest.mark.parametrize("with_labels", [True, False])
def test_odd_rows(spark, with_labels):
    rows = [(i, TRAIN[i % 4], "en" if i % 2 else "fr") for i in range(40)] + [(100, None, "en"), (101, "", None), (None, "the cat", None), (3, "again", "xx"), (3, "again", "xx")]
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(None, 1), (7, None)], "doc_id long, quality int")
    got = k.classify(frame(spark, rows), labels if with_labels else labels.limit(0)).collect()
    assert len(got) == len(rows)
    assert all(r.predicted == 0 for r in got if not r.n_chars or not with_labels)
    assert k.classify(frame(spark, []), labels).count() == 0


def test_characters_beyond_latin_stay_apart(spark):
    """Junk of the same characters is told from good text in any script."""
    import random

    good = {
        "zh": "今天天气很好我们去公园散步看见许多人在湖边唱歌跳舞孩子们放风筝老人下棋",
        "ko": "오늘은 날씨가 좋아서 공원에 산책을 갔습니다 많은 사람들이 노래를 불렀습니다",
        "ka": "დღეს კარგი ამინდია და ჩვენ პარკში ვსეირნობთ ბავშვები თამაშობენ",
    }
    rng = random.Random(3)
    for lang, text in good.items():
        model = k.train(frame(spark, [(i, text[i % 5 :], lang) for i in range(20)]))
        junk = "".join(rng.sample(text, len(text)))
        rows = frame(spark, [(1, text, lang), (2, junk, lang)]).select("doc_id", "text", "lang")
        got = {r.doc_id: r.perplexity for r in k.perplexities(rows, model).collect()}
        assert got[2] > 5 * got[1], (lang, got)
        p = brute_model([text[i % 5 :] for i in range(20)])
        assert math.isclose(got[2], brute_perplexity(p, junk), rel_tol=1e-9)


def test_quotes_and_signs_are_symbols_of_their_own():
    (head, gram), n, _ = k.codes(["“", "”", "–", "€", "中", "中"])
    assert len(set(zip(head.tolist(), gram.tolist(), strict=True))) == 5 and sorted(n.tolist()) == [1, 1, 1, 1, 2]


def test_many_different_characters_give_the_same_n_grams():
    """More characters than fit one integer by number: whole code points too."""
    text = "".join(chr(0x4E00 + 7 * i % 9000) for i in range(9000)) + "\U0010ffff"
    (head, gram), of, bounds = k.codes([text, "", text[:50]], places=True)
    assert bounds.tolist() == [0, len(text), len(text), len(text) + 50]
    for at in (0, 3, 5, 8999, 9000):
        own = [1] * 4 + [ord(c) + 2 for c in text]
        a, b, c, d, e = own[at : at + 5]
        assert (int(head[of[at]]), int(gram[of[at]])) == (a << 21 | b, c << 42 | d << 21 | e)
    assert of[: 50].tolist() == of[bounds[2] :].tolist()
    few = k.codes([text[:50]], places=True)
    assert few[0][0][few[1]].tolist() == head[of[:50]].tolist() and few[0][1][few[1]].tolist() == gram[of[:50]].tolist()


def test_probabilities_of_whole_code_points_sum_to_one(spark):
    model = k.train(frame(spark, [(i, t, "zh") for i, t in enumerate(["今天天气很好", "今天天气不好"])]))
    a, b, c, d = (ord(x) + 2 for x in "今天天气")
    grams = spark.range(k.SYMBOLS).selectExpr(f"{a << 21 | b}L AS head", f"{c << 42 | d << 21}L + id AS gram")
    assert math.isclose(k.probabilities(grams, model).selectExpr("sum(p)").first()[0], 1.0, rel_tol=1e-9)
