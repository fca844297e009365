"""The corpus pipeline, stage by stage against brute force."""

import pytest
from test_jaccard import brute_classes
from test_repeats import brute_ranges
from test_secrets import plain_base
from test_tokens import check_packing

import __spark_entry__ as entry
import corpus_pipeline as cp
from ledgerlens.llm import common
from ledgerlens.llm import queries as q

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = common.documents(spark, SF)
    out = [docs]
    for k, (_, stage) in enumerate(cp.STAGES):
        docs = common.written(stage(spark, docs, SF), f"test-{k}")
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "n-gram Jaccard join", "suffix-array dedup", "secret scan", "best-fit packing"]
    assert all(df.columns == stages[0].columns and df.dtypes == stages[0].dtypes for df in stages[1:5])


def test_toxic_documents_go(spark, stages):
    rejected = {r.doc_id for r in q.op1_segment_toxicity(spark, SF).collect() if r.predicted}
    every, kept = texts(stages[0]), texts(stages[1])
    assert set(kept) == set(every) - rejected and all(kept[d] == every[d] for d in kept)


def test_one_near_duplicate_stays(stages):
    before, after = texts(stages[1]), texts(stages[2])
    want = {d for d, n, c in brute_classes(sorted(before.items())) if not n or d == c}
    assert set(after) == want and all(after[d] == before[d] for d in after)


def test_repeats_are_taken_out(stages):
    before, after = texts(stages[2]), texts(stages[3])
    ids = sorted(before)
    raws, masks = brute_ranges([before[d] for d in ids], 200)
    assert set(after) == set(ids)
    for d, raw, mask in zip(ids, raws, masks, strict=True):
        assert after[d] == bytes(b for b, m in zip(raw, mask, strict=True) if not m).decode("utf-8", "ignore")


def test_secrets_are_taken_out(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(after) == set(before) and not any(plain_base(t or "") for t in after.values())
    changed = {d for d in before if before[d] != after[d]}
    assert {d for d in before if plain_base(before[d] or "")} <= changed
    assert all(r.n_chars == len(r.text or "") for r in stages[4].collect())


def test_everything_is_packed(stages):
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(texts(stages[4]))
    assert check_packing(rows, 4096) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_entry_lists_the_fourteen_queries():
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
