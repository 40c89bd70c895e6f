"""Project variables: the calendar window and the as-of date for recency."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Settings:
    """``end_date`` is exclusive: the calendar stops the day before it."""

    start_date: date = date(2026, 1, 1)
    end_date: date = date(2026, 12, 31)
    as_of: date = date(2026, 12, 31)
