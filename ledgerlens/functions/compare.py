"""Acceptance rules over a paired frame, as Spark SQL expressions.

A paired frame holds the first source's columns (``transaction_uid`` ...
``amount``, ``row_sha2``) next to the second source's (``..._2``,
``row2_sha2``). Every rule is a non-NULL boolean: a comparison involving NULL
counts as "not accepted". Rules are built as SQL text (``*_sql``) and wrapped
once with ``F.expr``, so a whole rule costs one call from Python to the JVM
and all rules are evaluated in one projection over one join.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.schemas import TRANSACTION_COLUMNS

LEFT_HASH = "row_sha2"
RIGHT_HASH = "row2_sha2"

# What a missing counter_login / comment is compared as.
NULL_AS = {"counter_login": "0L", "comment": "'0'"}


def compared(name: str, suffix: str = "") -> str:
    """A column as the rules compare it (a missing value may stand for one)."""
    return f"coalesce({name}{suffix}, {NULL_AS[name]})" if name in NULL_AS else f"{name}{suffix}"


def others(relaxed: str) -> tuple[str, ...]:
    """All compared columns but the one that a rule relaxes."""
    return tuple(c for c in TRANSACTION_COLUMNS if c != relaxed)


def _equal_others(relaxed: str) -> list[str]:
    return [f"{compared(c)} = {compared(c, '_2')}" for c in others(relaxed)]


def _non_empty(name: str) -> str:
    return f"({name} IS NOT NULL AND {name} <> '')"


def _all(*conds: str, as_filter: bool = False) -> str:
    """Conjunction; NULL counts as false. As a filter the bare conjunction is
    kept, so Catalyst sees it rejects NULLs (and can turn an outer join into
    an inner one)."""
    body = " AND ".join(f"({c})" for c in conds)
    return body if as_filter else f"coalesce({body}, false)"


def _differs() -> str:
    return f"{LEFT_HASH} <> {RIGHT_HASH}"


def left_present_sql() -> str:
    return f"{LEFT_HASH} IS NOT NULL"


def right_present_sql() -> str:
    return f"{RIGHT_HASH} IS NOT NULL"


def is_exact_sql(as_filter: bool = False) -> str:
    """Both rows present and their row hashes equal."""
    return _all(f"{LEFT_HASH} = {RIGHT_HASH}", as_filter=as_filter)


def most_edits(tolerance: int, inclusive: bool = False) -> int:
    """Largest accepted edit distance (-1: none)."""
    return int(tolerance) if inclusive else int(tolerance) - 1


def char_ok_sql(tolerance: int, inclusive: bool = False, as_filter: bool = False) -> str:
    """Only the comment differs, within an edit distance of the lower-cased texts.

    Both comments must be non-empty; distance ``< tolerance`` (``<=`` with
    ``inclusive``). The bounded distance stops early (-1: beyond the bound).
    """
    most = most_edits(tolerance, inclusive)
    near = f"levenshtein(lower(comment), lower(comment_2), {most}) >= 0" if most >= 0 else "false"
    return _all(
        _differs(), _non_empty("comment"), _non_empty("comment_2"), *_equal_others("comment"), near, as_filter=as_filter
    )


def date_ok_sql(tolerance: int, symmetric: bool = False, as_filter: bool = False) -> str:
    """Only the epoch differs; ``epoch1 - epoch2 < tolerance`` (or its absolute value)."""
    delta = "(unix_timestamp - unix_timestamp_2)"
    within = f"{'abs' if symmetric else ''}{delta} < {int(tolerance)}"
    return _all(
        _differs(), "unix_timestamp <> unix_timestamp_2", *_equal_others("unix_timestamp"), within, as_filter=as_filter
    )


def number_sql(value: int | Decimal) -> str:
    """A whole number or a decimal as a literal."""
    if isinstance(value, Decimal):
        return f"{value}BD"
    return f"{int(value)}L"


def int_ok_sql(tolerance: int | Decimal, as_filter: bool = False) -> str:
    """Only the amount differs, by at most ``tolerance`` percent of the first amount.

    Written without division: ``|a1 - a2| * 100 <= tolerance * |a1|`` with
    ``a1 <> 0`` -- exact in decimal arithmetic, and a zero first amount is
    rejected instead of raising a division by zero.
    """
    return _all(
        _differs(),
        *_equal_others("amount"),
        "amount <> 0",
        f"abs(amount - amount_2) * 100 <= {number_sql(tolerance)} * abs(amount)",
        as_filter=as_filter,
    )


def is_exact(as_filter: bool = False) -> Column:
    return F.expr(is_exact_sql(as_filter))


def char_ok(tolerance: int, inclusive: bool = False, as_filter: bool = False) -> Column:
    return F.expr(char_ok_sql(tolerance, inclusive, as_filter))


def date_ok(tolerance: int, symmetric: bool = False, as_filter: bool = False) -> Column:
    return F.expr(date_ok_sql(tolerance, symmetric, as_filter))


def int_ok(tolerance: int | Decimal, as_filter: bool = False) -> Column:
    return F.expr(int_ok_sql(tolerance, as_filter))
