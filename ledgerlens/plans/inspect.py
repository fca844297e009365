"""Plan inspection: the physical plan text and simple counts over it.

Used by tests to pin down plan shapes (no full outer join where an inner one
suffices, a single join for the classification, partial group limits,
pushed-down filters, no shuffle over bucketed inputs).
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count(df: DataFrame, pattern: str, mode: str = "simple") -> int:
    return len(re.findall(pattern, plan_text(df, mode)))


def exchanges(df: DataFrame) -> list[str]:
    """Shuffle exchanges of the physical plan (not broadcasts)."""
    return re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)[^\n]*", plan_text(df, "simple"))


def joins(df: DataFrame) -> list[str]:
    return re.findall(r"(\w+Join) [^\n]*", plan_text(df, "simple"))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan_text(df, "simple"))
