"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()


def prose(n: int, seed: int = 0) -> str:
    """``n`` words that differ from seed to seed."""
    return " ".join(WORDS[(i * i + seed * (i + 7)) % len(WORDS)] + str((i * seed) % 11) for i in range(n))


LONG = prose(60_000, 5)

AWKWARD = [
    (1, "A line that is long enough\nother"),
    (2, "a LINE that is long enough \nsecond\n"),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (6, "word"),
    (7, LONG),
    (8, LONG),
    (9, prose(40, 2)),
    (9, prose(40, 2)),
    (9, "another text under the same id"),
    (None, prose(40, 2)),
    (None, None),
    (10, "Größe ÉCLAIR 中文 🙂 \\ # </turn> <b>&amp;"),
]

# Names that the operators use inside.
EXTRA = ["fp", "doc", "text_hash", "keep", "n_dropped", "copy", "label", "cell", "rank", "lines"]


def awkward(spark, rows=AWKWARD, id_col="doc_id"):
    """A table of awkward rows with extra columns."""
    schema = f"{id_col} long, text string, " + ", ".join(f"{name} string" for name in EXTRA)
    return spark.createDataFrame([(*row, *EXTRA) for row in rows], schema)
