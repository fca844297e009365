"""Maximum matchings, against augmenting paths over single rows in plain Python."""

import random
from collections import Counter

import pytest

from ledgerlens.operators import matching as m

POOL = "_id long, side string, n long, g string, v long, t string"


def most_pairs(lefts, rights, accepts):
    """Size of a maximum matching of single rows."""
    holder = {}

    def place(i, tried):
        for j, r in enumerate(rights):
            if j not in tried and accepts(lefts[i], r):
                tried.add(j)
                if j not in holder or place(holder[j], tried):
                    holder[j] = i
                    return True
        return False

    return sum(place(i, set()) for i in range(len(lefts)))


def pool_of(spark, groups):
    """groups: {name: ([(v, t, n)] of the left, of the right)}."""
    rows = []
    for g, sides in groups.items():
        for side, items in zip("LR", sides, strict=True):
            rows += [(len(rows) + k, side, n, g, v, t) for k, (v, t, n) in enumerate(items)]
    return spark.createDataFrame(rows, POOL), {r[0]: r for r in rows}


def check(flows, rows, groups, accepts):
    """No row is used more often than it has copies, partners accept each other,
    and each group has as many pairs as can be."""
    used, pairs = Counter(), Counter()
    for f in flows:
        left, right = rows[f.l_id], rows[f.r_id]
        assert (left[1], right[1]) == ("L", "R") and left[3] == right[3] and f.n > 0 and accepts(left[4:], right[4:])
        used[f.l_id] += f.n
        used[f.r_id] += f.n
        pairs[left[3]] += f.n
    assert all(n <= rows[i][2] for i, n in used.items())
    for g, (lefts, rights) in groups.items():
        one = [[(v, t) for v, t, n in side for _ in range(n)] for side in (lefts, rights)]
        assert pairs[g] == (most_pairs(*one, accepts) if g is not None else 0), g


def random_groups(rng, names, values, most=9):
    out = {}
    for g in names:
        sides = [rng.sample(values, rng.randint(0, min(most, len(values)))) for _ in range(2)]
        out[g] = tuple([(v, t, rng.choice((1, 1, 1, 2, 3))) for v, t in side] for side in sides)
    return out


RULES = {
    "time, signed": ("v - 4", None, lambda a, b: a[0] - b[0] < 5),
    "time, symmetric": ("v - 4", "v + 4", lambda a, b: abs(a[0] - b[0]) < 5),
    "percent": ("v - abs(v) DIV 5", "v + abs(v) DIV 5", lambda a, b: abs(a[0] - b[0]) <= abs(a[0]) // 5),
    "falling ends": ("v - abs(v) * 2", "v + abs(v) * 2", lambda a, b: abs(a[0] - b[0]) <= 2 * abs(a[0])),
}


@pytest.mark.parametrize("rule", RULES)
@pytest.mark.parametrize("size", [250_000, 15])
def test_intervals_equal_brute_force(spark, monkeypatch, rule, size):
    """Random groups with surplus rows on either side, copies and a NULL group; small
    stretches give the same flows as whole groups."""
    monkeypatch.setattr(m, "GROUP_ROWS", size)
    low, high, accepts = RULES[rule]
    rng = random.Random(len(rule))
    values = [(v, "") for v in range(-30, 60)]
    groups = random_groups(rng, [*(f"g{k}" for k in range(40)), None], values)
    groups["long"] = tuple([(v, "", rng.choice((1, 2))) for v, _ in sorted(rng.sample(values, 45))] for _ in range(2))
    pool, rows = pool_of(spark, groups)
    check(m.interval_flows(pool, ["g"], "v", low, high, ["v", "t"]).collect(), rows, groups, accepts)


def test_stretches_change_no_flow(spark, monkeypatch):
    rng = random.Random(3)
    groups = {"a": tuple([(v, "", rng.choice((1, 5))) for v in sorted(rng.sample(range(400), 150))] for _ in range(2))}
    pool, _ = pool_of(spark, groups)
    for high in ("v + 6", None):
        found = []
        for size in (250_000, 100, 25):
            monkeypatch.setattr(m, "GROUP_ROWS", size)
            found.append(sorted(map(tuple, m.interval_flows(pool, ["g"], "v", "v - 6", high, ["v"]).collect())))
        assert found[0] == found[1] == found[2] and found[0]


def test_equal_values_that_do_not_go_together(spark):
    groups = {"a": ([(1, "", 1), (5, "", 1)], [(1, "", 1), (5, "", 1), (9, "", 1)])}
    pool, rows = pool_of(spark, groups)
    flows = m.interval_flows(pool, ["g"], "v", "v - 4", "v + 4", ["v"], strict="true").collect()
    check(flows, rows, groups, lambda a, b: a[0] != b[0] and abs(a[0] - b[0]) < 5)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most, size", [(0, 250_000), (1, 250_000), (1, 4), (2, 250_000)])
def test_texts_equal_brute_force(spark, monkeypatch, most, size):
    monkeypatch.setattr(m, "GROUP_ROWS", size)
    rng = random.Random(most)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in range(200)})
    groups = random_groups(rng, [*(f"g{k}" for k in range(40)), None], [(0, w) for w in words])
    groups["probe"] = ([(0, "pay", 1), (0, "xpay", 1)], [(0, "pay", 1), (0, "ay", 2)])
    pool, rows = pool_of(spark, groups)
    check(m.text_flows(pool, ["g"], "t", most, ["t"]).collect(), rows, groups, lambda a, b: edits(a[1], b[1]) <= most)


def test_many_copies_and_rows_of_one_text(spark, monkeypatch):
    monkeypatch.setattr(m, "COPIES_PER_CHUNK", 7)
    pool = spark.createDataFrame(
        [(1, "L", 1000, "g", 1, "x"), (2, "L", 5, "g", 2, "x"), (3, "R", 600, "g", 1, "x"), (4, "R", 600, "g", 2, "xy"), (5, "R", 9, "h", 2, "x")], POOL
    )
    flows = {(f.l_id, f.r_id): f.n for f in m.text_flows(pool, ["g"], "t", 1, ["v"]).collect()}
    assert sum(flows.values()) == 1005 and flows[1, 3] == 600
    assert m.text_flows(pool.filter("side = 'L'"), ["g"], "t", 1, ["v"]).count() == 0
    assert m.interval_flows(pool.filter("false"), ["g"], "v", "v", "v", ["v"]).count() == 0


def test_connected_sets(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 40) if k % 10 != 9], "a long, b long")
    assert {r.v: r.root for r in m.connected(links, "t").collect()} == {k: k - k % 10 for k in range(40)}


def test_row_sides_are_never_broadcast(spark):
    """Joins whose sides grow with the input deal out both, however small their files are."""
    from ledgerlens.plans import inspect

    values = [(v, "x" * (v % 3)) for v in range(20)]
    pool, _ = pool_of(spark, random_groups(random.Random(1), [f"g{k}" for k in range(5)], values))
    found = []
    write = m.stored

    def planned(df, name):
        found.append((name, inspect.plan_text(df, "simple")))
        return write(df, name)

    with pytest.MonkeyPatch.context() as mp:
        mp.setattr(m, "stored", planned)
        m.interval_flows(pool, ["g"], "v", "v - 3", "v + 3", ["v", "t"])
        m.text_flows(pool, ["g"], "t", 1, ["v"])
        mp.setattr(m, "GROUP_ROWS", 4)
        m.interval_flows(pool, ["g"], "v", "v - 3", "v + 3", ["v", "t"])
        m.text_flows(pool, ["g"], "t", 1, ["v"])
    # Lists and bounds of stretches have a row for many rows of a large group.
    rows = [(name, text) for name, text in found if not name.endswith(("-stretches", "-swept", "-sent", "-changed"))]
    assert sum("SortMergeJoin" in text for _, text in rows) >= 4
    assert not [name for name, text in rows if "BroadcastHashJoin" in text]


def test_copies_of_few_rows_are_expanded_once(spark):
    from ledgerlens.plans import inspect

    rows = spark.range(5).selectExpr("id", "id AS n")
    for most, unions in ((4, 0), (None, 1), (m.COPIES_PER_CHUNK + 1, 1)):
        out = m.expand(rows, "n", "k", most)
        assert inspect.plan_text(out, "simple").count("Union") == unions
        assert sorted((r.id, r.k) for r in out.collect()) == [(i, k) for i in range(5) for k in range(i)]


# --- through the pairing of the sources -------------------------------------------


def accepted(spark, left, right, tol):
    """(status, comment, time, amount) of accepted first rows; rows: (comment, epoch, amount) of one key."""
    from decimal import Decimal

    from ledgerlens.operators import reconcile as rec

    cols = "transaction_uid long, login long, counter_login long, transaction_type long, epoch_seconds long, comment string, amount decimal(18,4)"
    frames = [spark.createDataFrame([(1, 2, None, 3, t, c, Decimal(a)) for c, t, a in rows], cols) for rows in (left, right)]
    first = rec.load_ledger(frames[0].selectExpr("*", "CAST(timestamp_seconds(epoch_seconds) AS TIMESTAMP_NTZ) AS transaction_ts"))
    found = rec.clean_transactions(first, rec.load_second_source(frames[1]), tol, with_status=True).collect()
    return sorted((r.status, r.comment, int(r.amount)) for r in found)


def test_surplus_rows_do_not_shift_a_key(spark):
    from ledgerlens.config import Tolerances

    tol = Tolerances(percent=5, levenshtein=1, seconds=300, char_inclusive=True, symmetric_time=True)
    assert accepted(spark, [("c", 0, 10), ("c", 0, 100)], [("c", 0, 101), ("c", 0, 500)], tol) == [("int", "c", 100)]
    assert accepted(spark, [("abc", 0, 1), ("pay", 0, 1)], [("xpay", 0, 1), ("zzzzzz", 0, 1)], tol) == [("char", "pay", 1)]
    assert accepted(spark, [("c", 0, 7), ("c", 9000, 7)], [("c", 9100, 7), ("c", 50_000, 7)], tol) == [("date", "c", 7)]
    assert accepted(spark, [("pay", 0, 1), ("xpay", 0, 1)], [("pay", 0, 1), ("ay", 0, 1)], tol) == [("exact", "pay", 1)]


def test_scratch_tables_go_when_the_block_ends(spark):
    import os

    from ledgerlens.config import Tolerances
    from ledgerlens.session import scratch

    with scratch(spark) as folder:
        assert accepted(spark, [("c", 0, 10), ("c", 0, 100)], [("c", 0, 101), ("c", 0, 500)], Tolerances())
        assert os.listdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))
    with pytest.raises(ValueError), scratch(spark) as folder:
        spark.range(3).write.parquet(folder + "/x")
        raise ValueError
    assert not os.path.exists(folder.removeprefix("file:"))


def test_hot_keys_are_told_apart_without_a_join(spark, monkeypatch):
    """Keys above the bound leave the pairs as they are, rows without a key included."""
    from decimal import Decimal

    from ledgerlens.operators import reconcile as rec

    cols = "transaction_uid long, login long, counter_login long, transaction_type long, epoch_seconds long, comment string, amount decimal(18,4)"
    keys = [[7, 7, 7, 8, 8, 9, None, None], [7, 7, 8, 9, 10, None]]
    frames = [spark.createDataFrame([(k, 2, None, 3, i, "c", Decimal(5)) for i, k in enumerate(side)], cols) for side in keys]
    first = rec.load_ledger(frames[0].selectExpr("*", "CAST(timestamp_seconds(epoch_seconds) AS TIMESTAMP_NTZ) AS transaction_ts"))
    second = rec.load_second_source(frames[1])
    found = []
    for bound in (1_000_000, 3):
        monkeypatch.setattr(rec, "HEAVY_ROWS", bound)
        found.append(sorted((r.transaction_uid or 0, r.unix_timestamp or 0, r.transaction_uid_2 or 0, r.unix_timestamp_2 or 0) for r in rec.pair_sources(first, second).collect()))
    assert found[0] == found[1] and len(found[0]) == 3 + 2 + 1 + 1 + 2 + 1


def _sources(spark, keys, rng):
    """Loaded sources whose rows have the given keys and differ in few columns."""
    from decimal import Decimal

    from ledgerlens.operators import reconcile as rec

    cols = "transaction_uid long, login long, counter_login long, transaction_type long, epoch_seconds long, comment string, amount decimal(18,4)"
    usual = [5, None, 1, 100, "abc", Decimal(100)]
    other = [(6, None), (0, 3), (2,), (200, 900, None), ("ABC", "abd", "", None), (Decimal(0), Decimal(103), Decimal(300), None)]

    def row(key):
        values = list(usual)
        for c in rng.sample(range(6), rng.choice((0, 1, 1, 2))):
            values[c] = rng.choice(other[c])
        return (key, *values)

    frames = [spark.createDataFrame([row(k) for k in side], cols) for side in keys]
    first = frames[0].selectExpr("*", "CAST(timestamp_seconds(epoch_seconds) AS TIMESTAMP_NTZ) AS transaction_ts")
    return rec.load_ledger(first), rec.load_second_source(frames[1])


def _statuses(frame, tol):
    from ledgerlens.operators import reconcile as rec

    return Counter((r.transaction_uid or r.transaction_uid_2, r.status) for r in rec.reconciliation_report(frame, tol).collect())


def test_only_rows_with_a_choice_are_searched(spark, monkeypatch):
    """Rows that meet one row at most are judged by the rules alone; the statuses
    are those of a search among all rows."""
    from ledgerlens.config import Tolerances
    from ledgerlens.operators import reconcile as rec

    rng = random.Random(5)
    keys = [[k for k in range(60) for _ in range(rng.randint(0, 3))] + [None] * 2 for _ in range(2)]
    first, second = _sources(spark, keys, rng)
    tol = Tolerances(levenshtein=2)
    searched, texts = [], m.text_flows
    monkeypatch.setattr(m, "text_flows", lambda pool, *a, **b: (searched.append(pool.count()), texts(pool, *a, **b))[1])
    found = _statuses(rec.pair_sources(first, second, tol=tol), tol)
    judged = rec._judged
    # Every row counts as one with a choice.
    monkeypatch.setattr(rec, "_judged", lambda pool, tol: judged(pool, tol).selectExpr("_h", "true AS many", *(f"CASE WHEN false THEN {c} END AS {c}" for c in ("_ln", "_rn", *rec._ROW, *rec._RIGHT, "row2_sha2")), "false AS ok"))
    assert _statuses(rec.pair_sources(first, second, tol=tol), tol) == found
    assert 0 < searched[0] < searched[1]
    assert {s for _, s in found} >= {rec.EXACT, rec.CHAR, rec.DATE, rec.UNRECONCILED}


def test_keys_that_occur_once_may_go_with_repeated_ones(spark, monkeypatch):
    """The share of rows from which on they do changes no status, nor do hot keys."""
    from ledgerlens.config import Tolerances
    from ledgerlens.operators import reconcile as rec

    rng = random.Random(6)
    keys = [[k for k in range(50) for _ in range(rng.choice((0, 1, 1, 1, 4)))] + [None] * 3 for _ in range(2)]
    first, second = _sources(spark, keys, rng)
    tol, found = Tolerances(), []
    for share, heavy in ((0.0, 1_000_000), (0.0, 4), (2.0, 1_000_000)):
        monkeypatch.setattr(rec, "MOSTLY_REPEATED", share)
        monkeypatch.setattr(rec, "HEAVY_ROWS", heavy)
        frame = rec.pair_sources(first, second, tol=tol)
        assert frame.columns == [*first.columns, *second.columns]
        found.append(_statuses(frame, tol))
    assert found[0] == found[1] == found[2]
    inner = [rec.pair_sources(first, second, "inner", tol=tol).count() for share in (0.0, 2.0) if not monkeypatch.setattr(rec, "MOSTLY_REPEATED", share)]
    assert inner[0] == inner[1] == sum(n for (_, s), n in found[0].items() if s not in ("left_only", "right_only"))


def _written(monkeypatch):
    """Names of the tables that the pairing writes from now on."""
    from ledgerlens.operators import reconcile as rec

    names, stored = [], rec.stored
    monkeypatch.setattr(rec, "stored", lambda df, name: (names.append(name), stored(df, name))[1])
    return names


@pytest.mark.parametrize("how", ["full", "inner", "left", "right"])
def test_keys_without_a_choice_are_paired_where_they_are_dealt(spark, monkeypatch, how):
    """Their rows are dealt out twice, by key, and nothing but their contents is
    written; the pairs are those of the search among all rows."""
    from decimal import Decimal

    from ledgerlens.config import Tolerances
    from ledgerlens.operators import reconcile as rec

    cols = "transaction_uid long, login long, counter_login long, transaction_type long, epoch_seconds long, comment string, amount decimal(18,4)"
    first, second = [], []
    for k in range(30):
        # A row for each rule, by its own login, with copies; two rows on either side left over.
        for login, there in enumerate(((100, "abc", 100), (100, "abd", 100), (110, "abc", 100), (100, "abc", 102), (100, "zzz", 500))):
            first += [(k, 10 * k + login, None, 1, 100, "abc", Decimal(100))] * (1 + (k + login) % 2)
            second += [(k, 10 * k + login + (login == 4) * (k % 3), None, 1, there[0], there[1], Decimal(there[2]))] * (1 + k % 3)
    first, second = (spark.createDataFrame(rows, cols) for rows in (first, second))
    first = rec.load_ledger(first.selectExpr("*", "CAST(timestamp_seconds(epoch_seconds) AS TIMESTAMP_NTZ) AS transaction_ts"))
    second, tol = rec.load_second_source(second), Tolerances(levenshtein=2)
    with monkeypatch.context() as patch:
        names = _written(patch)
        paired = rec.pair_sources(first, second, how, tol=tol)
        assert names == ["repeated-keys", "repeated-content"]
    found = Counter(paired.collect())
    plan = paired._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Aggregate [" not in plan
    flagged = rec._with_choice
    monkeypatch.setattr(rec, "_with_choice", lambda groups: flagged(groups).selectExpr(*groups.columns, "true AS choice"))
    assert Counter(rec.pair_sources(first, second, how, tol=tol).collect()) == found
    statuses = {s for _, s in _statuses(paired, tol)}
    assert {"exact", "char", "date", "int", "unreconciled"} <= statuses


def test_choice_hot_keys_and_shared_hashes_change_no_status(spark, monkeypatch):
    """Keys with a choice, keys spread over tasks and rows with the same hash but
    other content go with the others."""
    from ledgerlens.config import Tolerances
    from ledgerlens.operators import reconcile as rec

    rng = random.Random(8)
    keys = [[k for k in range(40) for _ in range(rng.randint(0, 4))] + [None] * 2 for _ in range(2)]
    first, second = _sources(spark, keys, rng)
    tol, found = Tolerances(levenshtein=2), []
    flagged = rec._with_choice
    for bound, all_searched in ((100_000, True), (100_000, False), (3, False)):
        monkeypatch.setattr(rec, "SPREAD_ROWS", bound)
        monkeypatch.setattr(rec, "_with_choice", (lambda groups: flagged(groups).selectExpr(*groups.columns, "true AS choice")) if all_searched else flagged)
        found.append(_statuses(rec.pair_sources(first, second, tol=tol), tol))
    assert found[0] == found[1] == found[2]
    assert {s for _, s in found[0]} >= set(rec.STATUSES) - {"int"}
    # One hash for all rows of a key on both sides: step 1 pairs as many as there are.
    same = [df.selectExpr(*(c for c in df.columns if c != h), f"CAST({k} AS STRING) AS {h}") for df, k, h in ((first, "transaction_uid", "row_sha2"), (second, "transaction_uid_2", "row2_sha2"))]
    counts = _statuses(rec.pair_sources(*same, tol=tol), tol)
    sizes = [Counter(k for k in side if k is not None) for side in keys]
    assert all(counts[k, "exact"] == min(sizes[0][k], sizes[1][k]) for k in range(40))
