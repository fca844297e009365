"""Row hashing and text comparison helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator placed between column texts before hashing.
HASH_SEPARATOR = "||"


def _quote(name: str) -> str:
    return name if name.replace("_", "").isalnum() else f"`{name}`"


def row_hash_sql(columns: Sequence[str], null_token: str | None = None) -> str:
    """SHA-256 (hex) of the columns' texts joined by ``||`` in the given order.

    ``concat_ws`` skips NULLs, so by default (1, NULL, -1) and (1, -1, NULL)
    hash alike; pass ``null_token`` to write a marker for NULL instead.
    """
    parts = []
    for c in columns:
        text = f"CAST({_quote(c)} AS STRING)"
        if null_token is not None:
            escaped = null_token.replace("\\", "\\\\").replace("'", "\\'")
            text = f"coalesce({text}, '{escaped}')"
        parts.append(text)
    return f"sha2(concat_ws('{HASH_SEPARATOR}', {', '.join(parts)}), 256)"


def edit_distance_ci(a: str | Column, b: str | Column) -> Column:
    """Levenshtein distance of the lower-cased texts."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.levenshtein(F.lower(ca), F.lower(cb))
