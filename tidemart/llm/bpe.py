"""Byte-level BPE by tree reduction: halves are encoded on their own and joined at their boundary.

A text is halved down to short leaves. A leaf is split by the pattern, and the bytes of each
match are merged by the rank table. Two neighbours are joined by encoding a window across their boundary
again. It opens at a match of the left half and grows leftwards until its first match comes out as that half has it, and
it runs to the right until one of its matches ends where a match of the right half begins. Outside
nothing changes: splitting goes from left to right, so what follows a common start of a match is the same on
both sides, and what precedes it was split without a look at the other half. Decoding looks tokens up at the
leaves and concatenates up the tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAF_CHARS = 256
LEAF_TOKENS = 4096
# Matches that a window takes back from the left half to begin with.
FIRST_WINDOW = 2
# A longer match is merged once it is known to be whole, with a heap of its pairs.
SHORT_MATCH = 64
_NO_RANK = 1 << 62
_PART_BITS = 24
# Merged matches that are kept for the next time, at most.
REMEMBERED = 400_000
# A pattern that looks behind a match, or at a word's edge, could see the other half.
_LOOKS_BEHIND = ("(?<=", "(?<!", r"\b", r"\B", r"\A", r"\G", "(?m")


class RankTable:
    """The merges of one vocabulary; a token is known by its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self._ranks = ranks
        self._bytes = [ranks.get(bytes([b])) for b in range(256)]
        # By left and right part what the two become, for every way to cut a token in two.
        self._pairs = {
            left << _PART_BITS | right: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None
        }

    def merged(self, data: bytes) -> tuple[int, ...]:
        """The tokens of some bytes: of all neighbouring parts the pair of lowest rank is merged first, from the left."""
        whole = self._ranks.get(data)
        if whole is not None:
            return (whole,)
        return self._by_heap(data) if len(data) > SHORT_MATCH else self._by_search(data)

    def _by_search(self, data: bytes) -> tuple[int, ...]:
        rank, parts = self._pairs.get, [self._bytes[b] for b in data]
        pairs = [rank(a << _PART_BITS | b, _NO_RANK) for a, b in pairwise(parts)]
        while pairs and (least := min(pairs)) != _NO_RANK:
            at = pairs.index(least)
            parts[at] = least
            del parts[at + 1], pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] << _PART_BITS | least, _NO_RANK)
            if at < len(pairs):
                pairs[at] = rank(least << _PART_BITS | parts[at + 1], _NO_RANK)
        return tuple(parts)

    def _by_heap(self, data: bytes) -> tuple[int, ...]:
        """The same for long matches, whose pairs are not searched again for each merge."""
        parts, end = [self._bytes[b] for b in data], len(data)
        following, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(at: int, then: int) -> None:
            rank = self._pairs.get(parts[at] << _PART_BITS | parts[then])
            if rank is not None:
                heapq.heappush(heap, (rank, at, parts[at], parts[then]))

        for at in range(end - 1):
            offer(at, at + 1)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            then = following[at]
            # Pairs whose parts were merged meanwhile are passed over.
            if parts[at] != left or then >= end or parts[then] != right:
                continue
            parts[at], parts[then] = rank, -1
            following[at] = after = following[then]
            if after < end:
                before[after] = at
                offer(at, after)
            if before[at] >= 0:
                offer(before[at], at)
        return tuple([part for part in parts if part >= 0])


class _Merged(dict):
    """Matches and their tokens; merged when first asked for, but None for one that is too long."""

    def __init__(self, table: RankTable):
        super().__init__()
        self._table = table

    def __missing__(self, match: str) -> tuple[int, ...] | None:
        if len(match) > SHORT_MATCH:
            return None
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[match] = self._table.merged(match.encode())
        return ids


class _Part:
    """The matches of a part of the text as if it stood alone: where they start, and their tokens.

    None stands for the tokens of a match that may still grow, or is too long to be merged more than once.
    """

    __slots__ = ("starts", "tokens")

    def __init__(self, starts: list[int], tokens: list[tuple[int, ...] | None]):
        self.starts, self.tokens = starts, tokens


class ByteBpe:
    """Encoder and decoder of one vocabulary.

    ``ranks`` is the content of a rank file (a base64 token and its rank a line) and ``pattern``
    the regular expression that splits a text before merging. What no match covers has no token. A pattern that
    looks behind is refused.
    """

    def __init__(self, ranks: bytes, pattern: str, leaf_chars: int = LEAF_CHARS):
        if any(sign in pattern for sign in _LOOKS_BEHIND):
            raise ValueError("a pattern must not look behind its matches")
        pairs = (line.split() for line in ranks.splitlines() if line)
        vocabulary = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self._table = RankTable(vocabulary)
        self._pattern = regex.compile(pattern)
        self._merged = _Merged(self._table)
        self._tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, rank in vocabulary.items():
            self._tokens[rank] = token
        self._decimals = [str(i) for i in range(len(self._tokens))]
        self._leaf = max(1, leaf_chars)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, the same as encoding it in one go."""
        whole = self._encode(text, 0, len(text))
        if None in whole.tokens:
            ends = (*whole.starts[1:], len(text))
            for i, (start, end) in enumerate(zip(whole.starts, ends, strict=True)):
                if whole.tokens[i] is None:
                    # Text between this match and the next would belong to neither.
                    match = self._pattern.match(text, start, end).group()
                    whole.tokens[i] = self._merged[match] or self._table.merged(match.encode())
        return np.fromiter(chain.from_iterable(whole.tokens), np.int32)

    def _encode(self, text: str, low: int, high: int) -> _Part:
        if high - low <= self._leaf:
            return self._leaf_part(text, low, high)
        middle = (low + high) // 2
        return self._joined(text, low, high, self._encode(text, low, middle), self._encode(text, middle, high))

    def _leaf_part(self, text: str, low: int, high: int) -> _Part:
        if not self._pattern.groups:
            matches = self._pattern.findall(text, low, high)
            starts = list(accumulate(map(len, matches), initial=low))
            if starts.pop() == high:
                return _Part(starts, self._inner_tokens(matches))
        found = list(self._pattern.finditer(text, low, high))
        return _Part([m.start() for m in found], self._inner_tokens([m.group() for m in found]))

    def _inner_tokens(self, matches: list[str]) -> list[tuple[int, ...] | None]:
        """Tokens of all matches but the first and the last, which may go on in a neighbour."""
        if len(matches) < 3:
            return [None] * len(matches)
        return [None, *map(self._merged.__getitem__, matches[1:-1]), None]

    def _joined(self, text: str, low: int, high: int, left: _Part, right: _Part) -> _Part:
        middle, taken = (low + high) // 2, FIRST_WINDOW
        before, after = left.starts, right.starts
        while True:
            first = max(0, len(before) - taken)
            starts, matches, met, j = [], [], len(after), 0
            for match in self._pattern.finditer(text, before[first] if first else low, high):
                start = match.start()
                if start >= middle:
                    while j < len(after) and after[j] < start:
                        j += 1
                    if j < len(after) and after[j] == start:
                        met = j
                        break
                starts.append(start)
                matches.append(match.group())
            # A match is decided before the end of the second match after it, so if the first two starts
            # are as before, no earlier match has seen the other half either.
            if not first or starts[:2] == before[first : first + 2]:
                break
            taken *= 4
        tokens = list(map(self._merged.__getitem__, matches))
        if starts and (met == len(after)):
            tokens[-1] = None
        if starts and not first:
            tokens[0] = None
        return _Part(before[:first] + starts + after[met:], left.tokens[:first] + tokens + right.tokens[met:])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids."""
        if len(ids) <= LEAF_TOKENS:
            return b"".join(map(self._tokens.__getitem__, ids.tolist()))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])

    def decimal(self, ids: np.ndarray) -> Iterator[str]:
        """The ids as decimal numbers joined by one space, a piece at a time."""
        for at in range(0, len(ids), LEAF_TOKENS):
            names = map(self._decimals.__getitem__, ids[at : at + LEAF_TOKENS].tolist())
            yield " " * (at > 0) + " ".join(names)


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The rank file, read on the driver and sent out once; its size is the vocabulary's."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(
    documents: DataFrame, ranks: Broadcast, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, ids)``, one row per input row; a null or empty text has no ids. Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(ranks.value, pattern)
        for batch in batches:
            ids = [bpe.encode(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return _two_columns(documents, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, ranks: Broadcast, pattern: str) -> DataFrame:
    """``(doc_id, data)`` from ``(doc_id, ids)``: the bytes, empty for null or no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(ranks.value, pattern)
        for batch in batches:
            data = [bpe.decode(np.array(ids or [], np.int32)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"]
            )

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


_ROUND_TRIP = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
        ("ids", pa.list_(pa.int32())),
    ]
)


def round_trip(
    documents: DataFrame,
    ranks: Broadcast,
    pattern: str,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Texts encoded and decoded again in one pass, with digests of both.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``, one row per
    input row. Null texts count as empty; repeated rows come out as often as they come in. A text of any length is
    encoded whole, in one task; an empty table gives an empty result, and other columns are ignored.
    """
    schema = _ROUND_TRIP if with_ids else _ROUND_TRIP.remove(4)

    def digests(bpe: ByteBpe, doc_id: int | None, text: str | None) -> tuple:
        ids = bpe.encode(text or "")
        decimal = hashlib.sha256()
        for piece in bpe.decimal(ids):
            decimal.update(piece.encode())
        row = doc_id, len(ids), decimal.hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()
        return (*row, ids) if with_ids else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(ranks.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = zip(*(c.to_pylist() for c in part.columns), strict=True)
                columns = zip(*(digests(bpe, *row) for row in rows), strict=True)
                arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    kinds += ", ids array<int>" * with_ids
    return _two_columns(documents, id_col, text_col).mapInArrow(run, kinds)


def _two_columns(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
