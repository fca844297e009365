"""Calendar and epoch helpers (built-in Spark expressions, codegen friendly).

All conversions assume the session time zone is UTC (``session.apply_required``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed text formats used by the seed data and the ledger output.
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
SEED_FORMAT_SECONDS = "dd.MM.yyyy HH:mm:ss"
SEED_FORMAT_MINUTES = "dd.MM.yyyy HH:mm"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_epoch_seconds(ts: ColumnOrName) -> Column:
    """Timestamp -> whole epoch seconds (fraction dropped), as long."""
    return F.unix_timestamp(_col(ts)).cast("long")


def epoch_to_text(epoch: ColumnOrName) -> Column:
    """Epoch seconds -> ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.from_unixtime(_col(epoch), TS_TEXT_FORMAT)


def epoch_to_timestamp(epoch: ColumnOrName) -> Column:
    """Epoch seconds -> timestamp without time zone."""
    return F.timestamp_seconds(_col(epoch)).cast("timestamp_ntz")


def day_of(ts: ColumnOrName) -> Column:
    return F.to_date(_col(ts))


def month_start(ts: ColumnOrName) -> Column:
    """First day of the month, as a date (``date_trunc`` would give a timestamp)."""
    return F.trunc(F.to_date(_col(ts)), "month")


def day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Calendar days between two instants (day boundaries crossed, signed)."""
    return F.date_diff(F.to_date(_col(end)), F.to_date(_col(start)))


def add_days(ts: ColumnOrName, days: int | Column) -> Column:
    n = days if isinstance(days, Column) else F.lit(days)
    return F.timestamp_add("DAY", n, _col(ts))


def parse_seed_timestamp(text: ColumnOrName) -> Column:
    """Seed text ``dd.MM.yyyy HH:mm[:ss]`` -> timestamp; NULL when neither fits."""
    c = _col(text)
    return F.coalesce(
        F.try_to_timestamp(c, F.lit(SEED_FORMAT_SECONDS)),
        F.try_to_timestamp(c, F.lit(SEED_FORMAT_MINUTES)),
    ).cast("timestamp_ntz")
