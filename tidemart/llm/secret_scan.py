"""Secret scans: fixed patterns, and sliding-window Shannon entropy per character class.

Candidate strings are long runs of token characters. Over each class (hexadecimal digits, base-64
characters, digits with letters of one case, letters of both cases) a window slides along the run; the entropy of its
characters follows from counts that change by one character in and one out. Windows above the class's
threshold are joined to spans. Where a class has 16 to 23 characters in a row, these are one window.
What an allow-list matches is harmless: no window overlaps it, and the rest of the run is scanned.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

# The patterns of the three base kinds.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_VALUE = 6
# A text without one of these, in either case, has no assignment.
_ASSIGN_WORDS = ("passw", "secret", "token", "api")

WINDOW = 24
SHORTEST = 16
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# Per class its characters, the least entropy in bits per character of a window, and the kinds of
# character (digit, lower case, upper case) that a window must have, with how many of each. Random windows of 24 have
# about 3.4, 4.3, 4.0, 4.0 and 4.2 bits; words of any length stay below or have no digits, and names made of
# capitalised words have few capitals.
CLASSES = (
    (frozenset("0123456789abcdefABCDEF"), 2.9, 2, 1),
    (frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"), 3.8, 3, 1),
    (frozenset("abcdefghijklmnopqrstuvwxyz0123456789"), 3.6, 2, 1),
    (frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 3.5, 2, 1),
    (frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), 3.7, 2, 8),
)
# Where a class has fewer in a row: the least entropy, and how many of each kind. Of random strings of 16, 1 in 100 is below.
SHORT_LEAST = ((2.7, 1), (3.3, 1), (3.15, 1), (3.05, 1), (3.3, 5))
# Strings that look random and are no secrets; a word that names an example goes with what is joined to it.
ALLOWED = (
    r"(?i)(?:example|sample|dummy|placeholder|changeme|your[_-])[0-9a-z]{0,24}",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^(?:sha(?:1|256|384|512)|md5)[-=][0-9A-Za-z+/_-]{22,128}={0,2}$",
    r"(?i)0123456789abcdef|abcdefghijklmnopqrstuvwxyz|(.)\1{11,}",
    r"^/?(?:[A-Za-z_-]{1,16}[/=]){2,}",
)

# c * log2(c); a count is one above the window's length for a moment.
_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base kinds, leftmost and non-overlapping within each kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in _ASSIGN_WORDS):
        assigned = (m for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_VALUE)
        found += [(m.start(), m.end(), "assign") for m in assigned]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


def _kinds(window: dict[str, int], several: int) -> int:
    """How many kinds of character a window has ``several`` of."""
    tests = (str.isdigit, str.islower, str.isupper)
    return sum(sum(n for c, n in window.items() if test(c)) >= several for test in tests)


def random_spans(
    run: str, members: frozenset[str], least: float, kinds: int, several: int = 1
) -> Iterator[tuple[int, int]]:
    """Joined windows of ``WINDOW`` class members in a row with at least ``least`` bits each.

    The entropy of a window is ``log2(n) - sum(c * log2(c)) / n`` over its counts ``c``.
    """
    counts: dict[str, int] = {}
    total, length, span = 0.0, 0, None
    for at, char in enumerate(run):
        if char not in members:
            counts, total, length = {}, 0.0, 0
            continue
        n = counts.get(char, 0)
        counts[char] = n + 1
        total += _TERM[n + 1] - _TERM[n]
        length += 1
        if length > WINDOW:
            gone = run[at - WINDOW]
            n = counts[gone]
            counts[gone] = n - 1
            total -= _TERM[n] - _TERM[n - 1]
        if length >= WINDOW and math.log2(WINDOW) - total / WINDOW >= least and _kinds(counts, several) >= kinds:
            start = at + 1 - WINDOW
            if span and start <= span[1]:
                span = (span[0], at + 1)
            else:
                if span:
                    yield span
                span = (start, at + 1)
    if span:
        yield span


def _unmatched(run: str, allowed: tuple[re.Pattern, ...]) -> str:
    """The run with blanks, which no class has, in place of what an allow-list matches."""
    kept = run
    for pattern in allowed:
        for match in pattern.finditer(run):
            kept = kept[: match.start()] + " " * len(match[0]) + kept[match.end() :]
    return kept


def _in_a_row(members: frozenset[str]) -> re.Pattern:
    """Runs of class members that are too short for a window of ``WINDOW``."""
    one = f"[{re.escape(''.join(sorted(members)))}]"
    return re.compile(f"(?<!{one}){one}{{{SHORTEST},{WINDOW - 1}}}(?!{one})")


_SHORT = tuple(
    (_in_a_row(members), least, kinds, several)
    for (members, _, kinds, _), (least, several) in zip(CLASSES, SHORT_LEAST, strict=True)
)


def short_spans(
    run: str, pattern: re.Pattern, least: float, kinds: int, several: int = 1
) -> Iterator[tuple[int, int]]:
    """Matches of a pattern from ``_in_a_row`` with at least ``least`` bits a character."""
    for match in pattern.finditer(run):
        counts = Counter(match[0])
        bits = math.log2(len(match[0])) - sum(_TERM[n] for n in counts.values()) / len(match[0])
        if bits >= least and _kinds(counts, several) >= kinds:
            yield match.span()


def entropy_spans(text: str, allowed: tuple[re.Pattern, ...]) -> list[tuple[int, int, str]]:
    """Spans of high entropy over all classes, joined where they overlap."""
    spans = []
    for candidate in _CANDIDATE.finditer(text):
        run, at = _unmatched(candidate[0], allowed), candidate.start()
        if len(run) >= WINDOW:
            for members, *limits in CLASSES:
                spans += [(at + a, at + b) for a, b in random_spans(run, members, *limits)]
        for pattern, *limits in _SHORT:
            spans += [(at + a, at + b) for a, b in short_spans(run, pattern, *limits)]
    joined: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return [(start, end, "entropy") for start, end in joined]


def secret_spans(text: str, allowed: tuple[re.Pattern, ...]) -> list[tuple[int, int, str]]:
    """All spans by start, then kind. A span of high entropy within a base span adds nothing."""
    base = base_spans(text)
    added = [s for s in entropy_spans(text, allowed) if not any(b[0] <= s[0] and s[1] <= b[1] for b in base)]
    return sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """``(doc_id, spans)``, one row per input row.

    ``spans`` is an array of ``(kind, start, end)`` in code points, end exclusive, by start and then
    kind. ``allowed`` are regular expressions searched in candidate strings; they suppress the windows
    of high entropy that overlap a match, never spans of a base kind. A null text counts as empty; a text without
    findings has an empty array; an empty table gives an empty result, and a text of any length is scanned whole. Other columns are ignored.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = tuple(re.compile(p) for p in allowed)
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b} for a, b, k in secret_spans(text or "", patterns)]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: bigint, end: bigint>>")
