"""Ranks of groups that lie in several ranges."""

import random

import pytest

from ledgerlens.operators import ranking
from ledgerlens.plans import inspect

SCHEMA = "uid long, day date, op long"


def table(spark, seed):
    """A user with a third of the rows on one day, others with few; odd rows."""
    import datetime as dt

    rng, day = random.Random(seed), dt.date(2021, 3, 1)
    rows = [(1, day, i) for i in range(400)]
    rows += [(1, day + dt.timedelta(days=rng.randrange(-2, 3)), 1000 + i) for i in range(100)]
    rows += [(rng.randrange(2, 40), day + dt.timedelta(days=rng.randrange(9)), 2000 + i) for i in range(600)]
    rows += [(1, None, 5000), (1, None, 5001), (None, day, 5002), (None, None, 5003), (None, day, 5004)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("parts", [1, 3, 23])
@pytest.mark.parametrize(("function", "ties"), [("row_number", ("op",)), ("rank", ())])
def test_ranks_equal_one_window(spark, function, ties, parts):
    df = table(spark, parts)
    got = ranking.split_rank(df, function, "uid", "day", ties, "place", parts=parts)
    over = f"{function}() OVER (PARTITION BY uid ORDER BY {', '.join(('day', *ties))}) AS place"
    assert got.columns == ["uid", "day", "op", "place"]
    assert sorted(map(str, got.collect())) == sorted(map(str, df.selectExpr("*", over).collect()))


def test_one_day_of_one_user_lies_in_several_ranges(spark):
    df = table(spark, 1)
    dealt = ranking.ranges(df, ("uid", "day"), 23)
    sizes = [r["n"] for r in dealt.filter("uid = 1 AND day = DATE'2021-03-01'").groupBy("_range").agg({"*": "count"}).toDF("r", "n").collect()]
    assert len(sizes) >= 5 and max(sizes) <= 5 * 1105 / 23
    # The table that is broadcast has a row a range at most.
    before = ranking.earlier_rows(dealt, "uid", "day")
    assert 0 < before.count() <= 23 and before.select("_stretch").distinct().count() == before.count()


def test_windows_run_inside_ranges(spark):
    plan = inspect.plan_text(ranking.split_rank(table(spark, 2), "rank", "uid", "day", (), "place", parts=5))
    assert "BroadcastHashJoin" in plan and "_range" in plan


@pytest.mark.parametrize(("function", "ties"), [("row_number", ("op",)), ("rank", ())])
def test_empty_table(spark, function, ties):
    assert ranking.split_rank(spark.createDataFrame([], SCHEMA), function, "uid", "day", ties, "place").collect() == []
    with pytest.raises(ValueError):
        ranking.split_rank(table(spark, 1), "rank", "uid", "day", ("op",), "place")
