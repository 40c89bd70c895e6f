"""Assemble one self-contained statement per model from the texts in this package."""

from __future__ import annotations

import re
import textwrap
from collections.abc import Mapping

from tidemart.settings import Settings


def statement(name: str, texts: Mapping[str, str], settings: Settings) -> str:
    """``with a as (...), ... select * from name`` over the tables ``name`` needs."""
    needed = {name}
    order = list(texts)
    # A text only mentions tables above it, so one pass from the bottom finds them all.
    for table in reversed(order):
        if table in needed:
            needed |= {w for w in re.findall(r"\w+", texts[table]) if w in texts and w != table}
    parts = [f"{t} as (\n{textwrap.dedent(texts[t]).strip()}\n)" for t in order if t in needed]
    sql = "with " + ",\n".join(parts) + f"\nselect * from {name}"
    variables = {
        "__start__": settings.start_date,
        "__end__": settings.end_date,
        "__as_of__": settings.as_of,
    }
    for token, value in variables.items():
        sql = sql.replace(token, value.isoformat())
    return sql
