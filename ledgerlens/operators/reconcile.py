"""Two-source transaction reconciliation.

Both sources are reduced to the same seven columns in a fixed order and hashed
(``load_ledger`` / ``load_second_source``). They are paired on the
transaction key; each pair gets one status from a single ``CASE`` chain
(``classify``), so exact, comment, time and amount matches are all decided in
one pass over one join instead of one join per rule.

Pairing is one-to-one (see ``pair_sources``): where no key repeats on a side it
is the plain key join. Rows of a key that repeats are matched by the rules in
their order before what is left over is paired by number, so a key with n and
m rows yields max(n, m) pairs. Each rule makes as many pairs as can be made
(``operators.matching``), also where one side has surplus rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlens.config import Tolerances
from ledgerlens.functions import compare
from ledgerlens.functions.text import row_hash_sql
from ledgerlens.operators import matching
from ledgerlens.schemas import TRANSACTION_COLUMNS
from ledgerlens.session import stored

KEY = "transaction_uid"
SUFFIX = "_2"
LEFT_HASH = compare.LEFT_HASH
RIGHT_HASH = compare.RIGHT_HASH

# Fixed status names, in the order the rules are tried.
EXACT, CHAR, DATE, INT = "exact", "char", "date", "int"
UNRECONCILED, LEFT_ONLY, RIGHT_ONLY = "unreconciled", "left_only", "right_only"
ACCEPTED = (EXACT, CHAR, DATE, INT)
STATUSES = (EXACT, CHAR, DATE, INT, UNRECONCILED, LEFT_ONLY, RIGHT_ONLY)

CLEAN_COLUMNS = (
    "transaction_uid",
    "login",
    "counter_login",
    "transaction_type",
    "transaction_ts",
    "comment",
    "amount",
)


def with_row_hash(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    out: str = LEFT_HASH,
    null_token: str | None = None,
) -> DataFrame:
    """C4: add the SHA-256 of the columns (default: all, in frame order)."""
    cols = list(columns) if columns is not None else list(df.columns)
    return df.selectExpr("*", f"{row_hash_sql(cols, null_token)} AS {out}")


# Fixed types of the seven compared columns (the hash text depends on them).
_TYPES = ("bigint", "bigint", "bigint", "bigint", "bigint", "string", "decimal(18,4)")


def _typed(sources: Sequence[str], suffix: str = "") -> list[str]:
    return [
        f"CAST({src} AS {t}) AS {dst}{suffix}"
        for src, dst, t in zip(sources, TRANSACTION_COLUMNS, _TYPES, strict=True)
    ]


def load_ledger(
    table: DataFrame,
    ts_col: str = "transaction_ts",
    null_token: str | None = None,
) -> DataFrame:
    """Ledger rows -> the seven compared columns + ``row_sha2``.

    Rows are equal to later steps when these hashes are: give both sources the
    same ``null_token``, or none.
    """
    sources = ["transaction_uid", "login", "counter_login", "transaction_type",
               f"unix_timestamp({ts_col})", "comment", "amount"]
    return with_row_hash(table.selectExpr(*_typed(sources)), TRANSACTION_COLUMNS, LEFT_HASH, null_token)


def load_second_source(
    df: DataFrame,
    epoch_col: str = "epoch_seconds",
    null_token: str | None = None,
) -> DataFrame:
    """Second source -> the seven columns suffixed ``_2`` + ``row2_sha2``
    (``null_token`` as for ``load_ledger``)."""
    sources = ["transaction_uid", "login", "counter_login", "transaction_type", epoch_col, "comment", "amount"]
    suffixed = df.selectExpr(*_typed(sources, SUFFIX))
    return with_row_hash(suffixed, [c + SUFFIX for c in TRANSACTION_COLUMNS], RIGHT_HASH, null_token)


_LEFT = TRANSACTION_COLUMNS
_RIGHT = tuple(c + SUFFIX for c in TRANSACTION_COLUMNS)
_ROW = (*_LEFT, LEFT_HASH)  # a row of either side, under the first source's names
_JOINS = ("full", "inner", "left", "right")

# Leftover rows of a key are numbered within stretches of time of this length.
STRETCH_SECONDS = 86_400

# From this share of rows with a repeated key on, all rows are matched as those are:
# telling the others apart would deal out all rows twice. No result depends on it.
MOSTLY_REPEATED = 0.5

# Rows on a side from which a repeated key's rows are spread over tasks, for the
# ``HEAVY_KEYS`` keys with the most rows; no result depends on it.
SPREAD_ROWS = 100_000


def key_repeats(first: DataFrame, second: DataFrame) -> DataFrame:
    """Keys (not NULL) that occur more than once on a side, ``n``, their rows on the
    side with more of them, and ``both``, those of both sides. A partial aggregation,
    so a hot key stays one row a task."""
    return _repeats(_marked_keys(first, second))


def _marked_keys(first: DataFrame, second: DataFrame) -> DataFrame:
    marked = [df.selectExpr(f"{key} AS {KEY}", f"{l} AS l", f"{1 - l} AS r").filter(f"{KEY} IS NOT NULL") for df, key, l in ((first, KEY, 1), (second, KEY + SUFFIX, 0))]
    return marked[0].union(marked[1])


def _repeats(marked: DataFrame) -> DataFrame:
    return marked.groupBy(KEY).agg(F.expr("greatest(sum(l), sum(r)) AS n"), F.expr("sum(l + r) AS both")).filter("n > 1")


def repeated_keys(first: DataFrame, second: DataFrame) -> DataFrame:
    """K1 over both sources: keys (not NULL) that occur more than once on a side."""
    return key_repeats(first, second).select(KEY)


def pair_sources(
    first: DataFrame,
    second: DataFrame,
    how: str = "full",
    one_to_one: bool = True,
    tol: Tolerances | None = None,
    unique_keys: bool | None = None,
) -> DataFrame:
    """Pair the loaded sources on the transaction key.

    ``how='full'`` keeps unmatched rows of both sides (needed for the report);
    ``how='inner'`` suffices when only accepted pairs are wanted, because an
    unmatched row is never accepted (also ``'left'``, ``'right'``). With
    ``one_to_one=False`` a repeated key pairs every row with every row of the
    other side (the plain key join). A NULL key never pairs.

    One-to-one: keys that occur once on each side, at most, take the plain key
    join. ``unique_keys=True`` states that there are no others; None finds out
    with one small job over the keys (False: take the way for repeats anyway).
    Rows of other keys, or all rows if most have such a key, are matched, each row
    once, in this order:

    1. rows with the same content, then rows with the same hash;
    2. per rule of ``tol`` (comment, time, amount), a maximum matching of the rows
       that agree on all compared columns but the rule's own and that the rule
       accepts (the time rule's step also takes rows of equal time, where the
       amount rule accepts them). Times and amounts go in order, equal comments
       before near ones;
    3. what is left of a key, n-th with n-th by (unix_timestamp, login,
       counter_login, transaction_type, comment, amount), NULLs first.

    A key with n and m rows yields max(n, m) pairs. Steps write their result
    under the shared folder, so that none is repeated.
    """
    if how not in _JOINS:
        raise ValueError(f"how must be one of {sorted(_JOINS)}, got {how!r}")
    if not one_to_one:
        return _key_join(first, second, how)
    if unique_keys:
        return _key_join(first, second, how)
    seen = Observation()
    marked = _marked_keys(first, second).observe(seen, F.expr("count(1) AS rows"))
    repeated = stored(_repeats(marked).withColumnRenamed(KEY, "_rep"), "repeated-keys")
    of_repeated = repeated.agg(F.expr("coalesce(sum(both), 0L)")).first()[0]
    if unique_keys is None and not of_repeated:
        return _key_join(first, second, how)
    tol = tol or Tolerances()
    # The keys with the most rows, a bounded list, are told apart without a join.
    hot = [r["_rep"] for r in repeated.filter(f"n >= {min(SPREAD_ROWS, HEAVY_ROWS)}").orderBy(F.desc("n"), "_rep").limit(HEAVY_KEYS).collect()]
    if of_repeated >= MOSTLY_REPEATED * seen.get["rows"]:
        # Step 3 gives the pairs of the key join to keys that occur once, too.
        keyed = first.filter(f"{KEY} IS NOT NULL"), second.filter(f"{KEY + SUFFIX} IS NOT NULL")
        pairs = _pair_repeated(*keyed, how, tol, hot).select(*first.columns, *second.columns)
        return _with_keyless(pairs, first, second, how)
    keys = matching.shuffled(repeated.select("_rep"))
    once, often = [], []
    for df, key in ((first, KEY), (second, KEY + SUFFIX)):
        own, keyed = F.col(key) == F.col("_rep"), df.filter(f"{key} IS NOT NULL")
        rest = keyed.filter(~F.col(key).isin(hot)) if hot else keyed
        once.append(rest.join(keys, own, "left_anti"))
        few = rest.join(keys, own, "left_semi")
        often.append(few.unionByName(keyed.filter(F.col(key).isin(hot))) if hot else few)
    out = once[0].join(matching.shuffled(once[1]), F.expr(f"{KEY} = {KEY + SUFFIX}"), how)
    return _with_keyless(out, first, second, how).unionByName(_pair_repeated(*often, how, tol, hot))


def _key_join(first: DataFrame, second: DataFrame, how: str) -> DataFrame:
    """The plain key join; rows without a key, which pair with nothing, stay out
    of it where they are kept (all of them would be dealt to one task)."""
    on = F.expr(f"{KEY} = {KEY + SUFFIX}")
    if how == "inner":
        return first.join(second, on, how)
    out = first.filter(f"{KEY} IS NOT NULL").join(second.filter(f"{KEY + SUFFIX} IS NOT NULL"), on, how)
    return _with_keyless(out, first, second, how)


def _with_keyless(out: DataFrame, first: DataFrame, second: DataFrame, how: str) -> DataFrame:
    """The key join ``out`` and the rows without a key, on the sides that are kept."""
    none = [[f"CAST(NULL AS {t.dataType.simpleString()}) AS {t.name}" for t in df.schema.fields] for df in (first, second)]
    if how in ("full", "left"):
        out = out.unionByName(first.filter(f"{KEY} IS NULL").selectExpr("*", *none[1]))
    if how in ("full", "right"):
        out = out.unionByName(second.filter(f"{KEY + SUFFIX} IS NULL").selectExpr(*none[0], "*"))
    return out


def _both_sides() -> list[str]:
    """Columns of a pair from the row structs ``a`` (first) and ``z`` (second)."""
    return [*(f"a.{c} AS {c}" for c in _ROW), *(f"z.{c} AS {r}" for c, r in zip(_ROW, (*_RIGHT, RIGHT_HASH), strict=True))]


_AS_ROW = "named_struct(" + ", ".join(f"'{c}', {c}" for c in _ROW) + ")"


def _number_pairs(pool: DataFrame, number: str) -> DataFrame:
    """Rows of both sides (column side) with the same group ``_g`` and number."""
    return (
        pool.selectExpr("_g", "side", f"{number} AS _n", f"{_AS_ROW} AS row")
        .groupBy("_g", "_n")
        .agg(F.expr("max(CASE WHEN side = 'L' THEN row END) AS a"), F.expr("max(CASE WHEN side = 'R' THEN row END) AS z"))
    )


def _steps(tol: Tolerances) -> list[tuple[str, Callable[[DataFrame], DataFrame]]]:
    """Name and matching of each step over a pool of rows (see ``matching``)."""
    compared = {c: [compare.compared(x) for x in compare.others(c)] for c in ("comment", "unix_timestamp", "amount")}
    interval, text = matching.interval_flows, matching.text_flows
    steps: list[tuple[str, Callable[[DataFrame], DataFrame]]] = [
        ("hash", lambda pool: interval(pool, [KEY, LEFT_HASH], "0L", "0L", None, _ROW, name="same-hash"))
    ]
    most = compare.most_edits(tol.levenshtein, tol.char_inclusive)
    if most >= 0:
        given = "comment IS NOT NULL AND comment <> ''"
        steps.append((CHAR, lambda pool: text(pool, compared["comment"], "lower(comment)", most, ("comment", *_ROW), given, "near-comments")))
    # Rows of equal time are accepted by the amount rule, unless the amount is 0.
    low = f"unix_timestamp - {int(tol.seconds) - 1}L"
    high = f"unix_timestamp + {int(tol.seconds) - 1}L" if tol.symmetric_time else None
    equal = f"amount = 0 OR {compare.number_sql(tol.percent)} < 0"
    steps.append((DATE, lambda pool: interval(pool, compared["unix_timestamp"], "unix_timestamp", low, high, _ROW, equal, name="near-times")))
    # In hundreds, so that a percentage is exact: CAST keeps all digits of both.
    spread = f"CAST({compare.number_sql(tol.percent)} * abs(amount) AS DECIMAL(30, 10))"
    whole = "CAST(amount * 100 AS DECIMAL(30, 10))"
    steps.append(
        (INT, lambda pool: interval(pool, compared["amount"], whole, f"{whole} - {spread}", f"{whole} + {spread}", _ROW, usable="amount <> 0", name="near-amounts"))
    )
    return steps


_ORDER = ("unix_timestamp", *(c for c in _LEFT if c not in (KEY, "unix_timestamp")), LEFT_HASH)


def _meet_by_number(rest: DataFrame, hot: Sequence[int], keep: str) -> DataFrame:
    """Step 3: the rows of a key on both sides, n-th with n-th. A key's rows are dealt
    out once and numbered there. Those of ``hot`` keys need not meet in one task:
    numbers run over stretches of time, whose rows are numbered apart and whose
    sizes add up."""
    order = ", ".join(_ORDER)
    few = rest.filter(~F.col(KEY).isin(hot)) if hot else rest
    few = few.repartition(KEY).selectExpr("*", f"{KEY} AS _g", f"row_number() OVER (PARTITION BY {KEY}, side ORDER BY {order}) AS _r")
    out = _number_pairs(few, "_r").filter(keep).selectExpr(*_both_sides())
    if not hot:
        return out
    many = rest.filter(F.col(KEY).isin(hot)).selectExpr("*", f"{KEY} AS _g", f"coalesce(unix_timestamp DIV {STRETCH_SECONDS}, -9223372036854775808L) AS _s")
    before = (
        many.groupBy("_g", "side", "_s").agg(F.expr("count(1) AS n"))
        .selectExpr("_g", "side", "_s", "coalesce(sum(n) OVER (PARTITION BY _g, side ORDER BY _s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _before")
    )
    nth = many.selectExpr("*", f"row_number() OVER (PARTITION BY _g, side, _s ORDER BY {order}) AS _r").join(matching.shuffled(before), ["_g", "side", "_s"])
    return out.unionByName(_number_pairs(nth, "_r + _before").filter(keep).selectExpr(*_both_sides()))


# What rows must agree on whichever rule accepts them, by a hash: rows that do not
# share it never go together, rows that share it by chance are told apart by the rules.
_COMMON = matching.grouped_hash([compare.compared(c) for c in _LEFT if c not in ("comment", "unix_timestamp", "amount")])


def _with_choice(groups: DataFrame) -> DataFrame:
    """Rows of ``groups`` (a row per content, with its copies ``nl`` and ``nr`` on the
    sides) that are dealt out by key, and ``choice``: whether among what equal contents
    leave of the key some rows share ``_COMMON`` with several of a side."""
    run = f"OVER (PARTITION BY {KEY}, _h)"
    counted = groups.selectExpr("*", f"{_COMMON} AS _h").selectExpr("*", f"count_if(nl > nr) {run} > 1 OR count_if(nl < nr) {run} > 1 AS _many")
    return counted.selectExpr(*groups.columns, f"max(_many) OVER (PARTITION BY {KEY}) AS choice")


def _judged(pool: DataFrame, tol: Tolerances) -> DataFrame:
    """A row per ``_COMMON`` of the pool. With one row a side at most there is
    nothing to choose: both rows' columns, their copies ``_ln`` and ``_rn`` (NULL: no
    such row) and whether a rule accepts them (``ok``). Else ``many``, and no rows.
    Each task keeps one row a side of a hash, however many there are."""
    row = "named_struct('n', n, " + ", ".join(f"'{c}', {c}" for c in _ROW) + ")"
    sides = [f"max(CASE WHEN side = '{s}' THEN row END) AS {c}" for s, c in (("L", "a"), ("R", "z"))]
    met = pool.selectExpr(f"{_COMMON} AS _h", "side", f"{row} AS row").groupBy("_h").agg(F.expr("count_if(side = 'L') AS l"), F.expr("count_if(side = 'R') AS r"), *map(F.expr, sides))
    alone = met.selectExpr("_h", "l > 1 OR r > 1 AS many", *(f"CASE WHEN l <= 1 AND r <= 1 THEN {c} END AS {c}" for c in "az"))
    return alone.selectExpr("_h", "many", "a.n AS _ln", "z.n AS _rn", *_both_sides()).selectExpr("*", f"{_accepted(tol)} AS ok")


def _accepted(tol: Tolerances) -> str:
    """SQL: a rule of step 2 accepts the pair."""
    rules = [
        compare.char_ok_sql(tol.levenshtein, tol.char_inclusive),
        compare.date_ok_sql(tol.seconds, tol.symmetric_time),
        compare.int_ok_sql(tol.percent),
    ]
    return " OR ".join(rules)


_USED = "CASE WHEN ok THEN least(_ln, _rn) ELSE 0L END"


def _left_alone(judged: DataFrame) -> DataFrame:
    """Rows (side, the row, n copies) of ``_judged`` that no rule has paired."""
    left = judged.selectExpr("'L' AS side", *_ROW, f"_ln - {_USED} AS n")
    right = judged.selectExpr("'R' AS side", *(f"{r} AS {c}" for c, r in zip(_ROW, (*_RIGHT, RIGHT_HASH), strict=True)), f"_rn - {_USED} AS n")
    return left.unionByName(right).filter("n > 0")


def _met(rows: DataFrame, by: Sequence[str], *more: str) -> DataFrame:
    """Rows (side, row structs ``a`` and ``z``, of which one is NULL) that share ``by``,
    one a side at most and dealt out by a part of it, as one row. A sort, where an
    aggregation of structs would sort twice."""
    run = f"OVER (PARTITION BY {', '.join(by)} ORDER BY side)"
    there = rows.selectExpr("*", f"lead(z) {run} AS _z", f"lag(side) {run} AS _before").filter("_before IS NULL")
    return there.selectExpr(*more, "side", "a", "coalesce(z, _z) AS z")


def _without_choice(pool: DataFrame, tol: Tolerances, most: int, keep: str) -> DataFrame:
    """Steps 2 and 3 for keys without a choice, in the tasks their rows are dealt to:
    what the rules accept goes along (side 'B') while the rows left are numbered."""
    row = "named_struct(" + ", ".join(f"'{c}', {c}" for c in (*_ROW, "n")) + ")"
    sides = [f"CASE WHEN side = '{s}' THEN {row} END AS {c}" for s, c in (("L", "a"), ("R", "z"))]
    dealt = pool.selectExpr(f"{KEY} AS _g", f"{_COMMON} AS _h", "side", *_ROW, "n").repartition("_g").selectExpr("_g", "_h", "side", *sides)
    judged = _met(dealt, ["_g", "_h"], "_g").selectExpr("_g", "a", "z", "a.n AS _ln", "z.n AS _rn", *_both_sides()).selectExpr("_g", "a", "z", "_ln", "_rn", f"{_accepted(tol)} AS ok")
    none = "CASE WHEN false THEN a END"
    items = [f"named_struct('side', '{s}', 'a', {a}, 'z', {z}, 'n', {n})" for s, a, z, n in (("B", "a", "z", _USED), ("L", "a", none, f"_ln - {_USED}"), ("R", none, "z", f"_rn - {_USED}"))]
    rest = matching.expand(judged.selectExpr("_g", f"inline(array({', '.join(items)}))").filter("n > 0"), "n", most=most)
    order = ", ".join(f"coalesce(a.{c}, z.{c})" for c in _ORDER)
    numbered = rest.selectExpr("_g", "side", "a", "z", "side = 'B' AS _b", f"row_number() OVER (PARTITION BY _g, side ORDER BY {order}) AS _r")
    return _met(numbered, ["_g", "_b", "_r"]).filter(keep).selectExpr(*_both_sides())


def _without(pool: DataFrame, flows: DataFrame) -> DataFrame:
    """The pool's rows with the copies that the flows leave."""
    spent = flows.selectExpr("n AS _spent", "explode(array(l_id, r_id)) AS _of").groupBy("_of").agg(F.expr("sum(_spent) AS _spent"))
    left = pool.join(matching.shuffled(spent), F.expr("_id = _of"), "left").withColumn("n", F.expr("n - coalesce(_spent, 0L)"))
    return left.filter("n > 0").drop("_spent", "_of")


def _of_flows(flows: DataFrame, pool: DataFrame) -> DataFrame:
    """The flows with the columns of both rows, which are in the pool."""
    left = pool.filter("side = 'L'").selectExpr("_id AS _L", *_ROW)
    right = pool.filter("side = 'R'").selectExpr("_id AS _R", *(f"{c} AS {r}" for c, r in zip(_ROW, (*_RIGHT, RIGHT_HASH), strict=True)))
    met = flows.join(matching.shuffled(left), F.expr("l_id = _L")).join(matching.shuffled(right), F.expr("r_id = _R"))
    return met.select(*_ROW, *_RIGHT, RIGHT_HASH, "n")


def _pair_repeated(first: DataFrame, second: DataFrame, how: str, tol: Tolerances, hot: Sequence[int] = ()) -> DataFrame:
    """Steps 1 to 3 of ``pair_sources`` for rows of repeated keys, of which ``hot``
    are spread over tasks."""
    second = second.selectExpr(*(f"{r} AS {c}" for c, r in zip(_ROW, (*_RIGHT, RIGHT_HASH), strict=True)))
    # Step 1, by content. A key's rows go to one task, which sees whether they have a
    # choice. Those of hot keys are spread by content; copies collapse before the shuffle.
    marked = first.selectExpr(*_ROW, "1L AS l", "0L AS r").unionByName(second.selectExpr(*_ROW, "0L AS l", "1L AS r"))
    sums = F.expr("sum(l) AS nl"), F.expr("sum(r) AS nr")
    few = marked.filter(~F.col(KEY).isin(hot)) if hot else marked
    groups = _with_choice(few.repartition(KEY).groupBy(*_ROW).agg(*sums))
    if hot:
        spread = marked.filter(F.col(KEY).isin(hot)).groupBy(*_ROW).agg(*sums)
        groups = groups.unionByName(spread.selectExpr("*", "true AS choice"))
    groups = stored(groups.selectExpr("*", "monotonically_increasing_id() AS _id"), "repeated-content")
    most, searched = groups.agg(F.expr("coalesce(max(greatest(nl, nr)), 0L)"), F.expr("coalesce(max(choice), false)")).first()
    out = groups.selectExpr(*_ROW, *(f"{c} AS {r}" for c, r in zip(_ROW, (*_RIGHT, RIGHT_HASH), strict=True)), "least(nl, nr) AS n")
    pool = groups.filter("nl <> nr").selectExpr("CASE WHEN nl > nr THEN 'L' ELSE 'R' END AS side", *_ROW, "abs(nl - nr) AS n", "_id", "choice")
    keep = {"full": "true", "inner": "a IS NOT NULL AND z IS NOT NULL", "left": "a IS NOT NULL", "right": "z IS NOT NULL"}[how]
    (name, by_hash), *rules = _steps(tol)
    flows = by_hash(pool)
    if not flows.isEmpty():
        out, pool = out.unionByName(_of_flows(flows, pool)), stored(_without(pool, flows), f"repeated-after-{name}")
        searched, met = True, None
    else:
        met = _without_choice(pool.filter("NOT choice"), tol, most, keep)
        pool = pool.filter("choice")
    if searched:
        found, rest = _searched(pool.drop("choice"), tol, rules)
        out = out.unionByName(found)
        by_number = _meet_by_number(matching.expand(rest, "n", most=most), hot, keep)
        met = by_number if met is None else met.unionByName(by_number)
    return matching.expand(out, "n", most=most).drop("n").unionByName(met)


def _searched(pool: DataFrame, tol: Tolerances, rules: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]]) -> tuple[DataFrame, DataFrame]:
    """Step 2: the pairs that the rules make in the pool, with their copies ``n``, and the
    rows that are left. Only rows that have a choice are searched."""
    judged = stored(_judged(pool, tol), "repeated-judged")
    out = judged.filter("ok").select(*_ROW, *_RIGHT, RIGHT_HASH, F.expr("least(_ln, _rn) AS n"))
    rest = _left_alone(judged)
    choice = judged.filter("many").selectExpr("_h AS _many")
    if choice.isEmpty():
        return out, rest
    pool = pool.selectExpr("*", f"{_COMMON} AS _h").join(matching.shuffled(choice), F.expr("_h = _many"), "left_semi").drop("_h")
    pool = at_first = stored(pool, "repeated-pool")
    found = []
    for name, match in rules:
        flows = match(pool)
        if not flows.isEmpty():
            found.append(flows)
            pool = stored(_without(pool, flows), f"repeated-after-{name}")
    # The rows of all rules' flows at once: ids hold through the steps.
    if found:
        out = out.unionByName(_of_flows(reduce(DataFrame.unionByName, found), at_first))
    return out, rest.unionByName(pool.select(*rest.columns))


# Rows of one key that one task should join at most, keys looked at for it, and tasks
# that rows without a key are dealt to; no result depends on them.
HEAVY_ROWS, HEAVY_KEYS, NULL_SALTS = 1_000_000, 1000, 64


def heavy_keys(first: DataFrame, second: DataFrame) -> list[tuple[int, int, int]]:
    """(key, rows in the first source, rows in the second) of keys that hold
    ``HEAVY_ROWS`` or more on a side. A heavy-hitter sketch of each side
    (merged from all tasks) names them, then exactly those are counted. A key beyond
    ``HEAVY_KEYS`` others as heavy is joined as any other."""
    sides = [df.select(F.col(c).alias(KEY)).filter(f"{KEY} IS NOT NULL") for df, c in ((first, KEY), (second, KEY + SUFFIX))]
    found: set[int] = set()
    for keys in sides:
        top = keys.agg(F.expr(f"approx_top_k({KEY}, {HEAVY_KEYS}, {10 * HEAVY_KEYS}) AS top")).first().top
        found |= {t["item"] for t in top or () if t["count"] >= HEAVY_ROWS}
    if not found:
        return []
    counts = [{r[KEY]: r["count"] for r in keys.filter(F.col(KEY).isin(*found)).groupBy(KEY).count().collect()} for keys in sides]
    pairs = [(k, *(c.get(k, 0) for c in counts)) for k in sorted(found)]
    return [p for p in pairs if max(p[1:]) >= HEAVY_ROWS]


def full_outer_spread(first: DataFrame, second: DataFrame, heavy: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """The plain full outer key join in one join, whose heavy keys and rows
    without a key are dealt to many tasks.

    The rows of a heavy key are dealt over salts on the side that has more of
    them and repeated for each salt on the other. A repeated row that meets none of
    the dealt rows under a salt meets some under another, as the key was counted on
    both sides; it is dropped there, so the rows are those of the plain join."""
    heavy = heavy_keys(first, second) if heavy is None else heavy
    spark = first.sparkSession
    rows = [(k, -(-max(n, m) // HEAVY_ROWS), n >= m, n > 0 and m > 0) for k, n, m in heavy]
    # At most 2 * HEAVY_KEYS rows, whatever the sources.
    plan = F.broadcast(spark.createDataFrame(rows, "_heavy long, _salts long, _first_dealt boolean, _both boolean"))
    sides = []
    for df, key, dealt, mark in ((first, KEY, "_first_dealt", "_1"), (second, KEY + SUFFIX, "NOT _first_dealt", "_2")):
        salts = (
            f"CASE WHEN {key} IS NULL THEN array(pmod(monotonically_increasing_id(), {NULL_SALTS}L)) WHEN _salts IS NULL THEN array(0L)"
            f" WHEN {dealt} THEN array(pmod(monotonically_increasing_id(), _salts)) ELSE sequence(0L, _salts - 1) END"
        )
        known = df.join(plan, F.col(key) == F.col("_heavy"), "left").selectExpr(*df.columns, f"{salts} AS _all", f"coalesce(_both AND NOT ({dealt}), false) AS _repeated{mark}")
        sides.append(known.selectExpr(*df.columns, f"_repeated{mark}", f"explode(_all) AS _salt{mark}"))
    met = sides[0].join(sides[1], F.expr(f"{KEY} = {KEY + SUFFIX} AND _salt_1 = _salt_2"), "full")
    real = "NOT (coalesce(_repeated_1, false) AND _salt_2 IS NULL) AND NOT (coalesce(_repeated_2, false) AND _salt_1 IS NULL)"
    return met.filter(real).select(*first.columns, *second.columns)


def status_sql(tol: Tolerances) -> str:
    """One status per pair: the first rule that accepts it, in ``STATUSES`` order."""
    return (
        f"CASE WHEN NOT ({compare.left_present_sql()}) THEN '{RIGHT_ONLY}'"
        f" WHEN NOT ({compare.right_present_sql()}) THEN '{LEFT_ONLY}'"
        f" WHEN {compare.is_exact_sql()} THEN '{EXACT}'"
        f" WHEN {compare.char_ok_sql(tol.levenshtein, tol.char_inclusive)} THEN '{CHAR}'"
        f" WHEN {compare.date_ok_sql(tol.seconds, tol.symmetric_time)} THEN '{DATE}'"
        f" WHEN {compare.int_ok_sql(tol.percent)} THEN '{INT}'"
        f" ELSE '{UNRECONCILED}' END"
    )


def passed_statuses_sql(tol: Tolerances) -> str:
    """Every accepting rule of a pair, as an array (empty when none accepts)."""
    rules = [
        (EXACT, compare.is_exact_sql()),
        (CHAR, compare.char_ok_sql(tol.levenshtein, tol.char_inclusive)),
        (DATE, compare.date_ok_sql(tol.seconds, tol.symmetric_time)),
        (INT, compare.int_ok_sql(tol.percent)),
    ]
    flagged = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in rules)
    return f"filter(array({flagged}), s -> s IS NOT NULL)"


def classify(paired: DataFrame, tol: Tolerances | None = None) -> DataFrame:
    """Add ``status`` to every pair."""
    return paired.selectExpr("*", f"{status_sql(tol or Tolerances())} AS status")


def _left_seven(df: DataFrame) -> DataFrame:
    return df.select(*TRANSACTION_COLUMNS)


def exact_matches(paired: DataFrame) -> DataFrame:
    """Pairs with equal row hashes, first source's columns."""
    return _left_seven(paired.filter(compare.is_exact(as_filter=True)))


def char_rec(paired: DataFrame, tolerance: int, inclusive: bool = False) -> DataFrame:
    """Pairs that differ only in the comment, within the edit distance."""
    return _left_seven(paired.filter(compare.char_ok(tolerance, inclusive, as_filter=True)))


def date_rec(paired: DataFrame, tolerance: int, symmetric: bool = False) -> DataFrame:
    """Pairs that differ only in the epoch, within the tolerance."""
    return _left_seven(paired.filter(compare.date_ok(tolerance, symmetric, as_filter=True)))


def int_rec(paired: DataFrame, tolerance) -> DataFrame:
    """C11: pairs that differ only in the amount, within ``tolerance`` percent."""
    return _left_seven(paired.filter(compare.int_ok(tolerance, as_filter=True)))


# The first source's values in ledger order; the epoch back to a timestamp.
CLEAN_SELECT = (
    "transaction_uid", "login", "counter_login", "transaction_type",
    "CAST(timestamp_seconds(unix_timestamp) AS timestamp_ntz) AS transaction_ts", "comment", "amount",
)


def clean_transactions(
    first: DataFrame,
    second: DataFrame,
    tol: Tolerances | None = None,
    multi: bool = False,
    with_status: bool = False,
    one_to_one: bool = True,
    unique_keys: bool | None = None,
) -> DataFrame:
    """Accepted rows of the first source, ledger column order.

    Each accepted pair is emitted once, with the first accepting rule
    (``multi=False``); with ``multi=True`` a pair is emitted once per accepting
    rule, as a union of the per-rule results would. Unmatched rows are never
    accepted, so the pairing is an inner join here.
    """
    tol = tol or Tolerances()
    paired = pair_sources(first, second, "inner", one_to_one, tol, unique_keys)
    if multi:
        tagged = paired.selectExpr("*", f"explode({passed_statuses_sql(tol)}) AS status")
    else:
        accepted = ", ".join(f"'{s}'" for s in ACCEPTED)
        tagged = classify(paired, tol).filter(f"status IN ({accepted})")
    return tagged.selectExpr(*CLEAN_SELECT, *(["status"] if with_status else []))


def reconciliation_report(paired: DataFrame, tol: Tolerances | None = None) -> DataFrame:
    """C17: one status per pair, unmatched rows included, with the values of
    both sides (the seven columns, then those of the second source) and status."""
    return classify(paired, tol).select(*_LEFT, *_RIGHT, "status")


def reconciliation_summary(report: DataFrame) -> DataFrame:
    """Pairs per status (statuses with no pair are left out)."""
    return report.groupBy("status").agg(F.expr("count(1) AS pairs"))
