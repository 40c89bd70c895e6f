"""Chat formatting: event logs folded to final messages, then rendered with a loss mask.

A log has one event per row: ``conv_id, seq, message, kind, role, text``. ``start`` opens a
message with its role, ``delta`` appends text, ``edit`` replaces the text so far, ``regenerate``
discards it so that later deltas write it anew, and ``retract`` takes the message out. Events of a
message are folded in order of ``seq``, a message at a time, so that a conversation with very many
messages is spread over tasks. Turns are then laid out one row each; a whole conversation is never
held in memory, only hashed as its turns stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DELTA_CHARS = 256

# The template: OPEN role BETWEEN text CLOSE, one after the other.
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
# Every backslash in the output starts an escape, and neither '#' nor '<' is left in a text.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escaped(value: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    """A text in which no control string of the template can stand."""
    for plain, code in pairs:
        value = F.replace(value, F.lit(plain), F.lit(code))
    return value


def unescaped(value: str) -> str:
    """The text that was escaped."""
    if "\\" in value:
        for plain, code in reversed(ROLE_ESCAPES):
            value = value.replace(code, plain)
    return value


def events_of_turns(conversations: DataFrame, piece: int = DELTA_CHARS) -> DataFrame:
    """A log that says what the turns say: a start and the text streamed in deltas, for each row.

    Turns with a null number come last; rows with the same number are put in order of role and
    text. A null text is empty, a null role ``unknown``. Rows are told apart by their place in the
    input, so read the table from files or store it first.
    """
    row = F.monotonically_increasing_id().alias("row")
    message = F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "text", row)
    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))
    opened = F.concat(F.array(F.lit(None).cast("string")), pieces)
    role = F.coalesce("role", F.lit("unknown"))
    whole = conversations.select(
        "conv_id", message.alias("message"), role.alias("role"), opened.alias("pieces")
    )
    streamed = whole.select("conv_id", "message", "role", F.posexplode("pieces").alias("seq", "text"))
    return streamed.select(
        "conv_id",
        F.col("seq").cast("long").alias("seq"),
        "message",
        F.when(F.col("seq") == 0, "start").otherwise("delta").alias("kind"),
        F.when(F.col("seq") == 0, F.col("role")).alias("role"),
        "text",
    )


def fold(events: DataFrame) -> DataFrame:
    """``(conv_id, message, role, text)``: the final messages of a log.

    An event that comes twice counts once. A message without a start has the role ``unknown``; one
    whose last event is a ``retract`` is left out. Null texts add nothing.
    """
    event = F.struct("seq", "kind", "role", "text")
    resets = F.col("kind").isin("start", "edit", "regenerate")
    folded = events.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_set(event)).alias("events"),
        F.max(F.when(resets, F.col("seq"))).alias("since"),
    )
    current = F.filter("events", lambda e: F.col("since").isNull() | (e["seq"] >= F.col("since")))
    texts = F.transform(current, lambda e: F.coalesce(e["text"], F.lit("")))
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull())
    return folded.where(F.element_at("events", -1)["kind"] != "retract").select(
        "conv_id",
        "message",
        F.coalesce(F.get(roles, F.lit(0)), F.lit("unknown")).alias("role"),
        F.array_join(texts, "").alias("text"),
    )


def rendered(messages: DataFrame) -> DataFrame:
    """The turns in order with their rendered form and places in the conversation's output.

    Returns ``conv_id, message, formatted, start, loss_start, loss_end``: the conversation's output
    is its ``formatted`` pieces one after the other; ``start`` is the piece's place in it, in code
    points, and assistant texts lie under the loss mask from ``loss_start`` to ``loss_end``.
    """
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), ROLE_ESCAPES), F.lit(BETWEEN))
    body = escaped(F.col("text"))
    pieces = messages.select("conv_id", "message", "role", head.alias("head"), body.alias("body"))
    pieces = pieces.select(
        "conv_id",
        "message",
        (F.col("role") == "assistant").alias("learned"),
        F.char_length("head").alias("n_head"),
        F.char_length("body").alias("n_body"),
        F.concat("head", "body", F.lit(CLOSE)).alias("formatted"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("formatted").cast("long")).over(earlier), F.lit(0))
    loss_start = F.when(F.col("learned"), F.col("start") + F.col("n_head"))
    return pieces.withColumn("start", start).select(
        "conv_id", "message", "formatted", "start",
        loss_start.alias("loss_start"), (loss_start + F.col("n_body")).alias("loss_end"),
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Event logs to rendered turns: see :func:`fold` and :func:`rendered`. Empty in, empty out."""
    return rendered(fold(events))


def read_turns(pieces: Iterator[str]) -> Iterator[tuple[str, str]]:
    """Roles and texts read back from output that comes in pieces of any size."""
    held = ""
    for piece in pieces:
        *whole, held = (held + piece).split(CLOSE)
        for turn in whole:
            role, _, text = turn.removeprefix(OPEN).partition(BETWEEN)
            yield unescaped(role), unescaped(text)
    if held:
        raise ValueError("the output ends within a turn")


class _Digest:
    """What is read back of one conversation, a turn at a time."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int, loss_start: int | None, loss_end: int | None) -> None:
        for role, text in read_turns(iter([formatted])):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        if loss_start is not None:
            learned = unescaped(formatted[loss_start - start : loss_end - start])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
        self.chars += len(formatted)

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


_DIGEST_ROW = (
    "conv_id long, n_turns long, turns_sha256 string, "
    "loss_chars long, loss_sha256 string, formatted_chars long"
)
_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        done = []
        for conv_id, *piece in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv_id)
            now.add(*piece)
        yield pa.RecordBatch.from_pylist(done, schema=_DIGEST)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], schema=_DIGEST)


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation what a reader finds in its output, the pieces streaming by in order."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "start")
    pieces = ordered.select("conv_id", "formatted", "start", "loss_start", "loss_end")
    return pieces.mapInArrow(_digests, _DIGEST_ROW)
