"""Typed reconciliation settings.

The tolerances are numbers, never text: a textual ``"5"`` cannot be negated
or compared with a number under ANSI rules.
"""

from __future__ import annotations

import configparser
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

# Fixed defaults: percent deviation of the amount, edit distance of the
# comment, seconds between the two timestamps.
DEFAULT_PERCENT = 5
DEFAULT_LEVENSHTEIN = 1
DEFAULT_SECONDS = 300
INI_SECTION = "tolerance_vars"


@dataclass(frozen=True)
class Tolerances:
    """Per-type acceptance limits.

    ``percent``: |a1 - a2| * 100 <= percent * |a1| (inclusive, a1 <> 0).
    ``levenshtein``: distance of lower-cased comments < levenshtein, or <= when
    ``char_inclusive``.
    ``seconds``: epoch1 - epoch2 < seconds (signed), or |epoch1 - epoch2| <
    seconds when ``symmetric_time``.
    """

    percent: int | Decimal = DEFAULT_PERCENT
    levenshtein: int = DEFAULT_LEVENSHTEIN
    seconds: int = DEFAULT_SECONDS
    char_inclusive: bool = False
    symmetric_time: bool = False

    def __post_init__(self) -> None:
        for name in ("percent", "levenshtein", "seconds"):
            value = getattr(self, name)
            if isinstance(value, bool) or not isinstance(value, (int, Decimal)):
                raise TypeError(f"tolerance {name} must be a number, got {value!r}")
            if value < 0:
                raise ValueError(f"tolerance {name} must be >= 0, got {value!r}")

    @classmethod
    def from_mapping(cls, values: Mapping[str, str], **flags: bool) -> Tolerances:
        """Build from text settings (e.g. an INI section), converting types."""
        percent_text = values.get("tolerance_percent", str(DEFAULT_PERCENT)).strip()
        percent: int | Decimal = Decimal(percent_text)
        if percent == percent.to_integral_value():
            percent = int(percent)
        return cls(
            percent=percent,
            levenshtein=int(values.get("tolerance_levenshtein", DEFAULT_LEVENSHTEIN)),
            seconds=int(values.get("tolerance_seconds", DEFAULT_SECONDS)),
            **flags,
        )

    @classmethod
    def from_ini(cls, path: str, **flags: bool) -> Tolerances:
        parser = configparser.ConfigParser()
        if not parser.read(path):
            raise FileNotFoundError(path)
        return cls.from_mapping(parser[INI_SECTION], **flags)
