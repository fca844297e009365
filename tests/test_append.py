"""Guarded append to file targets."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources import append as ap

SCHEMA = "uid string, login long, note string, day date"
DAY = dt.date(2022, 5, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(k, note="n", day=0):
    return (f"u{k}", k, note, None if day is None else DAY + dt.timedelta(days=day))


def test_rerun_adds_nothing_and_clashes_are_reported(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    first = [row(k, day=k % 5) for k in range(50)] + [row(90, None, None), (None, None, "x", DAY)]
    got = ap.guarded_append(frame(spark, [*first, first[0]]), path, "day", ["uid", "login"])
    assert (got.added, got.present, got.clashing, got.read) == (52, 1, 0, ())
    again = ap.guarded_append(frame(spark, first), path, "day", ["uid", "login"])
    assert (again.added, again.present, again.clashing) == (0, 52, 0)
    # New, present, same key in another partition, same key with other values,
    # two rows of one new key, NULL key with other values.
    batch = [row(60, day=9), row(1, day=1), row(2, day=8), row(3, "other", 3), row(70, "a"), row(70, "b"), (None, None, "y", DAY)]
    got = ap.guarded_append(frame(spark, batch), path, "day", ["uid", "login"])
    assert (got.added, got.present, got.clashing) == (1, 1, 5)
    assert {tuple(r) for r in spark.read.schema(SCHEMA).parquet(got.clashes).collect()} == {tuple(b) for b in batch[2:]}
    stored = ap.read_appended(spark, path, frame(spark, []).schema).select("uid", "login", "note", "day")
    assert sorted(map(str, map(tuple, stored.collect()))) == sorted(str(tuple(r)) for r in [*first, batch[0]])


def test_only_touched_partitions_are_read(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    ap.guarded_append(frame(spark, [row(k, day=k % 30) for k in range(300)]), path, "day", ["uid"])
    batch = frame(spark, [row(4, day=4), row(34, day=4), row(1000, day=2)])
    got = ap.guarded_append(batch, path, "day", ["uid"])
    assert (got.added, got.present) == (1, 2) and len(got.read) <= 2 and DAY + dt.timedelta(days=4) in got.read
    table = ap.read_appended(spark, path, batch.schema).filter(ap.in_partitions("day", [DAY + dt.timedelta(days=4)]))
    assert {f.rsplit("/", 2)[1] for f in table.inputFiles()} == {f"day={DAY + dt.timedelta(days=k)}" for k in range(30)}
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [day" in plan
    assert {r.f.rsplit("/", 2)[1] for r in table.select(F.input_file_name().alias("f")).collect()} == {f"day={DAY + dt.timedelta(days=4)}"}


@pytest.mark.parametrize("words", [1, 4, 1 << 18])
def test_filters_lose_no_key(spark, tmp_dir, words):
    """However full the filters are, every partition that holds a key is named."""
    rng, path = random.Random(words), f"{tmp_dir}/t"
    rows = [row(k, day=rng.choice([None, *range(6)])) for k in range(80)]
    ap.guarded_append(frame(spark, rows), path, "day", ["uid"], words)
    some = rng.sample(rows, 5)
    named = ap.touched(spark, path, frame(spark, some), "day", ["uid"], words)
    assert {r[3] for r in some} <= set(named)
    got = ap.guarded_append(frame(spark, rows + [row(500)]), path, "day", ["uid"], words)
    assert (got.added, got.present, got.clashing) == (1, 80, 0)


def test_a_failure_between_filters_and_rows_is_made_good(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    rows = frame(spark, [row(k, day=k % 3) for k in range(9)])
    ap.key_filters(rows, "day", ["uid"]).write.parquet(f"{path}/filters")
    assert ap.guarded_append(rows, path, "day", ["uid"]).added == 9
    assert ap.read_appended(spark, path, rows.schema).count() == 9


def test_empty_batch_and_wrong_columns(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert ap.guarded_append(frame(spark, []), path, "day", ["uid"]).added == 0
    assert ap.read_appended(spark, path, frame(spark, []).schema).count() == 0
    with pytest.raises(ValueError):
        ap.guarded_append(frame(spark, []), path, "month", ["uid"])
