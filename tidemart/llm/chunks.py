"""Document fingerprints by content-defined chunking.

A gear hash rolls over the bytes of a text; where its top bits are zero a chunk may end. Chunking is
normalised: below the usual length more bits must be zero than above it, so lengths stay close to
the usual one, between a least and a greatest length. Boundaries depend on the last sixteen bytes
only, so they move along with an insertion or deletion. The fingerprint is the set of chunk digests
with their lengths; the share of a fingerprint's length that another one holds is its containment.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, USUAL, MOST = 16, 48, 192
# Zero bits at the top of the 16-bit gear hash that end a chunk below and above the usual length.
STRICT_BITS, LOOSE_BITS = 7, 4
GEAR = np.frombuffer(b"".join(hashlib.sha256(bytes([b])).digest()[:2] for b in range(256)), np.uint16)
SLAB = 1 << 20
# Documents between two heads, on average, unless that gives more heads than the driver and the
# tasks are to hold. A task reads its block a document at a time; a head's text goes to two blocks.
DOCS_PER_BLOCK = 512
MOST_HEADS = 65_536


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of the last sixteen bytes' gears, each shifted by its distance."""
    hashes = GEAR[data]
    for step in (1, 2, 4, 8):
        hashes = np.concatenate([hashes[:step], hashes[step:] + (hashes[:-step] << np.uint16(step))])
    return hashes


def boundaries(data: bytes) -> list[int]:
    """Where the chunks of a text end; the last is the text's end."""
    raw, loose, strict = np.frombuffer(data, np.uint8), [], []
    for at in range(0, len(raw), SLAB):
        low = max(0, at - 15)
        hashes = gear_hashes(raw[low : at + SLAB])[at - low :]
        ends = np.flatnonzero(hashes < 1 << (16 - LOOSE_BITS))
        loose += (ends + at + 1).tolist()
        strict += (ends[hashes[ends] < 1 << (16 - STRICT_BITS)] + at + 1).tolist()
    found, start, n = [], 0, len(data)
    while n - start > LEAST:
        i = bisect_left(strict, start + LEAST)
        if i < len(strict) and strict[i] < start + USUAL:
            start = strict[i]
        else:
            i = bisect_left(loose, start + USUAL)
            start = min(loose[i] if i < len(loose) else n, start + MOST, n)
        found.append(start)
    if start < n:
        found.append(n)
    return found


def chunk_set(data: bytes) -> dict[str, int]:
    """The digests of a text's distinct chunks, in order of appearance, with the chunks' lengths."""
    chunks, start, digest = {}, 0, xxhash.xxh64_hexdigest
    for end in boundaries(data):
        chunks[digest(data[start:end])[:12]] = end - start
        start = end
    return chunks


def containment(one: dict[str, int], other: dict[str, int]) -> float:
    """The share of one set's length whose chunks the other holds; empty sets are only like each other."""
    if not one:
        return float(not other)
    return sum(n for d, n in one.items() if d in other) / sum(one.values())


def written(chunks: dict[str, int]) -> str:
    """A fingerprint as text: each chunk's digest and its length in hexadecimal digits."""
    return ",".join([f"{d}{n:x}" for d, n in chunks.items()])


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)``, one row per input row; null texts count as empty."""

    @F.pandas_udf("string")
    def of(texts):
        return texts.map(lambda text: written(chunk_set((text or "").encode())))

    return documents.select(F.col(id_col).alias("doc_id"), of(F.col(text_col)).alias("fingerprint"))


def in_sequence(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    docs_per_block: int = DOCS_PER_BLOCK,
) -> DataFrame:
    """The documents dealt to tasks so that each meets the next one: ``doc_id, text, block, guest``.

    Ids whose hash is a multiple of the block size, and the smallest id, head a block. A block's
    head is also the last row, a ``guest``, of the block before it, and the first head a guest of the
    last block. So only heads travel twice. Blocks grow beyond ``docs_per_block`` where there would be
    over ``MOST_HEADS`` of them, about so many ids being what the driver gets and sends out. There
    are as many tasks as blocks.
    """
    rows = documents.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    ids = rows.select("doc_id")
    n_docs, least = ids.agg(F.count("*"), F.min("doc_id")).first()
    size = max(docs_per_block, -(-n_docs // MOST_HEADS))
    chosen = ids.where((F.pmod(F.xxhash64("doc_id"), F.lit(size)) == 0) | (F.col("doc_id") == F.lit(least)))
    heads = np.unique(chosen.distinct().toArrow().column(0).to_numpy())
    last, sent = max(0, len(heads) - 1), documents.sparkSession.sparkContext.broadcast(heads)

    @F.pandas_udf("int")
    def block_of(doc_ids):
        places = np.searchsorted(sent.value, doc_ids.to_numpy(), side="right") - 1
        return pd.Series(places.astype(np.int32))

    @F.pandas_udf("boolean")
    def is_head(doc_ids):
        return pd.Series(np.isin(doc_ids.to_numpy(), sent.value))

    block = F.col("block")
    before = F.when(block == 0, F.lit(last)).otherwise(block - 1)
    own = F.struct(block.alias("block"), F.lit(False).alias("guest"))
    guest = F.struct(before.alias("block"), F.lit(True).alias("guest"))
    places = F.when(F.col("head"), F.array(own, guest)).otherwise(F.array(own))
    return (
        rows.select("doc_id", "text", block_of("doc_id").alias("block"), is_head("doc_id").alias("head"))
        .select("doc_id", "text", F.explode(places).alias("at"))
        .select("doc_id", "text", "at.block", "at.guest")
        .repartition(max(1, len(heads)), "block")
        .sortWithinPartitions("block", "guest", "doc_id", "text")
    )


_LIKENESS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
_LIKENESS_ROW = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compared(
    doc_id: int | None, text: str, chunks: dict[str, int], after: str, chunks_after: dict[str, int]
) -> tuple:
    tail = len(text) // 4
    edited = (text[: len(text) - tail] + after[:tail]).encode()
    edited_chunks = chunk_set(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited).hexdigest(),
        written(chunks),
        written(edited_chunks),
        containment(chunks, edited_chunks),
        containment(chunks, chunks_after),
    )


def _with_next(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Each row of a block beside the one after it; a block's guest only follows."""
    held = None
    for doc_id, text, block, guest in rows:
        if held and held[3] != block:
            held = None
        if guest and held is None:
            continue
        chunks = chunk_set(text.encode())
        if held:
            yield _compared(*held[:3], text, chunks)
        held = None if guest else (doc_id, text, chunks, block)


def likeness(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    docs_per_block: int = DOCS_PER_BLOCK,
) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    The edited text has the last quarter of the code points replaced by the next document's first
    as many; next is by ascending id, the first after the last; rows that share an id follow each
    other in order of text. ``near_edited`` and ``near_next`` are the containment of the
    document's fingerprint in the other. Null texts count as empty. A row with a null id has no
    next document: its tail is cut off and ``near_next`` compares with an empty text. An empty
    table gives an empty result. Other columns are ignored.
    """

    def packed(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for part in batched(rows, 500):
            columns = zip(zip(*part, strict=True), _LIKENESS, strict=True)
            arrays = [pa.array(values, field.type) for values, field in columns]
            yield pa.RecordBatch.from_arrays(arrays, schema=_LIKENESS)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield from zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True)

    def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(_with_next(values(batches)))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (text or "" for (text,) in values(batches))
        yield from packed(_compared(None, text, chunk_set(text.encode()), "", {}) for text in texts)

    nameless = documents.where(F.col(id_col).isNull()).select(F.col(text_col).alias("text"))
    return (
        in_sequence(documents, id_col, text_col, docs_per_block)
        .mapInArrow(in_blocks, _LIKENESS_ROW)
        .unionByName(nameless.mapInArrow(alone, _LIKENESS_ROW))
    )
