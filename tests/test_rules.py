"""Acceptance rules on hand-made pairs: the positive cases and their boundaries."""

from decimal import Decimal

import pytest
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from ledgerlens.config import Tolerances
from ledgerlens.operators import reconcile as rec

SIDE = [
    ("transaction_uid", LongType()),
    ("login", LongType()),
    ("counter_login", LongType()),
    ("transaction_type", LongType()),
    ("unix_timestamp", LongType()),
    ("comment", StringType()),
    ("amount", DecimalType(18, 4)),
]
PAIRED = StructType(
    [StructField(n, t) for n, t in SIDE]
    + [StructField("row_sha2", StringType())]
    + [StructField(n + "_2", t) for n, t in SIDE]
    + [StructField("row2_sha2", StringType())]
)

# A refund to an account with a counter party, at noon of a leap day.
NOON = 1709208000
BASE = dict(
    transaction_uid=900,
    login=12,
    counter_login=77,
    transaction_type=1,
    unix_timestamp=NOON,
    comment="Refund no. 8",
    amount=Decimal("240.5000"),
)


def pair(left=None, right=None, same_hash=False):
    l_row = {**BASE, **(left or {})}
    r_row = {**BASE, **(right or {})}
    names = [n for n, _ in SIDE]
    return tuple(l_row[n] for n in names) + ("h1",) + tuple(r_row[n] for n in names) + (
        "h1" if same_hash else "h2",
    )


def run(spark, fn, rows, *args, **kwargs):
    df = spark.createDataFrame(rows, PAIRED)
    return [tuple(r) for r in fn(df, *args, **kwargs).collect()]


def first_values(row):
    return tuple(row[: len(SIDE)])


# --- comment (char) ---------------------------------------------------------


@pytest.mark.parametrize("right", ["REFUND NO. 8", "refund No. 8", "rEFUND nO. 8"])
def test_char_accepts_any_change_of_case(spark, right):
    p = pair(right={"comment": right})
    assert run(spark, rec.char_rec, [p], 1) == [first_values(p)]
    assert run(spark, rec.char_rec, [p], 0) == []


@pytest.mark.parametrize(
    "right_comment, tol, inclusive, accepted",
    [
        ("refund no. 9", 1, False, False),  # distance 1, strict < 1
        ("refund no. 9", 2, False, True),
        ("refund no. 9", 1, True, True),  # inclusive reading of the tolerance
        ("refund no 88", 2, False, False),  # distance 2
        ("refund no 88", 2, True, True),
        ("refund", 5, True, False),  # distance 6
    ],
)
def test_char_distance_boundaries(spark, right_comment, tol, inclusive, accepted):
    p = pair(right={"comment": right_comment})
    assert bool(run(spark, rec.char_rec, [p], tol, inclusive=inclusive)) is accepted


@pytest.mark.parametrize("left_comment, right_comment", [(None, "x"), ("", "x"), ("x", None), ("x", "")])
def test_char_needs_two_non_empty_comments(spark, left_comment, right_comment):
    p = pair(left={"comment": left_comment}, right={"comment": right_comment})
    assert run(spark, rec.char_rec, [p], 5) == []


def test_char_rejects_second_difference(spark):
    for second in ({"amount": Decimal("240.5001")}, {"login": 13}, {"transaction_type": -1}, {"unix_timestamp": NOON + 1}, {"counter_login": None}):
        assert run(spark, rec.char_rec, [pair(right={"comment": "REFUND NO. 8", **second})], 1) == []


def test_equal_hashes_are_not_tolerance_matches(spark):
    p = pair(right={"comment": "REFUND NO. 8"}, same_hash=True)
    assert run(spark, rec.char_rec, [p], 1) == []
    assert run(spark, rec.exact_matches, [p]) == [first_values(p)]


# --- time (date) ------------------------------------------------------------


def test_date_returns_the_first_sources_time(spark):
    early, late = pair(left={"unix_timestamp": NOON - 3600}), pair(left={"unix_timestamp": NOON + 299})
    assert run(spark, rec.date_rec, [early, late], 300) == [first_values(early), first_values(late)]
    assert run(spark, rec.date_rec, [early, late], 300, symmetric=True) == [first_values(late)]
    assert run(spark, rec.date_rec, [pair()], 300) == []  # the same second is no difference


@pytest.mark.parametrize(
    "delta, symmetric, accepted",
    [
        (299, False, True),
        (300, False, False),  # strict
        (-299, True, True),
        (-100000, False, True),  # signed difference: a much later second source passes
        (-100000, True, False),
        (300, True, False),
    ],
)
def test_date_boundaries(spark, delta, symmetric, accepted):
    p = pair(left={"unix_timestamp": NOON + delta})
    assert bool(run(spark, rec.date_rec, [p], 300, symmetric=symmetric)) is accepted


def test_date_null_comment_equals_null_but_not_empty(spark):
    both_null = pair(left={"unix_timestamp": NOON - 40, "comment": None}, right={"comment": None})
    null_vs_empty = pair(left={"unix_timestamp": NOON - 40, "comment": None}, right={"comment": ""})
    assert len(run(spark, rec.date_rec, [both_null], 300)) == 1
    assert run(spark, rec.date_rec, [null_vs_empty], 300) == []


# --- amount (int) -----------------------------------------------------------


@pytest.mark.parametrize("right", ["240.5001", "252.5250", "228.4750"])
def test_int_accepts_small_deviations_either_way(spark, right):
    p = pair(right={"amount": Decimal(right)})
    assert run(spark, rec.int_rec, [p], 5) == [first_values(p)]


@pytest.mark.parametrize(
    "left, right, accepted",
    [
        ("100", "105", True),  # exactly +5 %
        ("100", "95", True),  # exactly -5 %
        ("100", "105.0001", False),
        ("100", "94.9999", False),
        ("-100", "-104", True),
        ("0", "0", False),  # no division by zero, rejected
        ("0", "1", False),
    ],
)
def test_int_boundaries(spark, left, right, accepted):
    p = pair(left={"amount": Decimal(left)}, right={"amount": Decimal(right)})
    assert bool(run(spark, rec.int_rec, [p], 5)) is accepted


def test_int_null_amount_rejected(spark):
    p = pair(right={"amount": None})
    assert run(spark, rec.int_rec, [p], 5) == []


def test_int_fractional_tolerance(spark):
    p = pair(left={"amount": Decimal("1000")}, right={"amount": Decimal("1005")})
    assert run(spark, rec.int_rec, [p], Decimal("0.5")) == [first_values(p)]
    assert run(spark, rec.int_rec, [p], Decimal("0.4")) == []


# --- one status per pair ----------------------------------------------------


def test_counter_null_vs_zero_once_or_twice(spark):
    # Hashes differ only because NULL and 0 are written differently; the pair
    # passes both the comment rule (distance 0) and the amount rule (0 %).
    p = pair(left={"counter_login": None}, right={"counter_login": 0})
    df = spark.createDataFrame([p], PAIRED)
    statuses = [r.status for r in rec.classify(df, Tolerances()).collect()]
    assert statuses == ["char"]
    passed = df.selectExpr(f"{rec.passed_statuses_sql(Tolerances())} AS p").collect()[0].p
    assert passed == ["char", "int"]


def test_status_of_unmatched_and_unreconciled(spark):
    names = [n for n, _ in SIDE]
    left_only = tuple(BASE[n] for n in names) + ("h1",) + (None,) * 8
    right_only = (None,) * 8 + tuple(BASE[n] for n in names) + ("h2",)
    two_errors = pair(right={"amount": Decimal("241"), "unix_timestamp": NOON - 10})
    df = spark.createDataFrame([left_only, right_only, two_errors], PAIRED)
    got = sorted(r.status for r in rec.classify(df, Tolerances()).collect())
    assert got == ["left_only", "right_only", "unreconciled"]


def test_tolerances_are_typed():
    with pytest.raises(TypeError):
        Tolerances(percent="5")
    with pytest.raises(ValueError):
        Tolerances(seconds=-1)
    t = Tolerances.from_mapping({"tolerance_percent": "5", "tolerance_levenshtein": "1", "tolerance_seconds": "300"})
    assert (t.percent, t.levenshtein, t.seconds) == (5, 1, 300)
    assert Tolerances.from_mapping({"tolerance_percent": "2.5"}).percent == Decimal("2.5")


def test_sizing_conf_scales_with_input():
    from ledgerlens.session import sizing_conf

    small = sizing_conf(10 * 1024**2, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"
    big = sizing_conf(100 * 1024**4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
