"""Near duplicates by SimHash: popcount embedding, grid join under Manhattan distance, exact check.

A fingerprint is cut into six groups of bits and each group into segments of two bits. The
embedding of a fingerprint is the vector of its segments' bit counts. Flipping a bit moves one
count by one, so the Manhattan distance of two embeddings never exceeds the number of differing
bits. A distance of three or less leaves at least three of the six groups without any difference:
near fingerprints share the unit grid cell of some three groups. Twenty choices of three groups
give twenty grids; pairs that meet in a cell pass the Manhattan bound over all segments, then the
exact bit count.

Copies collapse to one row per distinct fingerprint before the grids. A cell with many
fingerprints is dealt out as pairs of blocks, and a task returns a spanning forest of what it
links, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.components import connected_components
from tidemart.llm.tables import free_names, stored, utf8

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# Fingerprints of a cell that one task compares with each other; larger cells are dealt out in
# pairs of blocks of about this size.
BLOCK = 1024

GROUP_BITS = (11, 11, 11, 11, 10, 10)
SEGMENT_BITS = 2
BYTES_AT_ONCE = 1 << 20
WHITE = b" \t\n\x0b\x0c\r"


def word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, about a megabyte of text at a time."""
    start = 0
    while start < len(data):
        end = min(len(data), start + BYTES_AT_ONCE)
        while end < len(data) and data[end] not in WHITE:
            end += 1
        yield data[start:end].split()
        start = end


def fingerprint(data: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text as a signed 64-bit integer.

    Words are runs without ASCII white space, A-Z lower-cased. Repeated shingles count each time.
    A text with fewer words than a shingle is one shingle; a text without words gives 0.
    """
    ones, total, carry = np.zeros(64, np.int64), 0, []
    digest, joined = xxhash.xxh64_intdigest, b" ".join
    for words in word_blocks(data.lower()):
        words = carry + words
        shifted = [words[i:] for i in range(words_per_shingle)]
        hashes = np.array([digest(joined(s), SEED) for s in zip(*shifted, strict=False)], np.uint64)
        if hashes.size:
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            total += hashes.size
        carry = words[max(0, len(words) - words_per_shingle + 1) :]
    if total == 0:
        if not carry:
            return 0
        return int(np.uint64(digest(joined(carry), SEED)).view(np.int64))
    majority = np.packbits(2 * ones > total, bitorder="little")
    return int(majority.view(np.int64)[0])


def _fingerprints(words_per_shingle: int):
    @F.pandas_udf("long")
    def of(texts):
        return texts.map(lambda data: fingerprint(data, words_per_shingle)).astype("int64")

    return of


def fingerprints(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS
) -> DataFrame:
    """``(doc_id, fp)``, one row per input row; a null text counts as empty."""
    return documents.select(
        F.col(id_col).alias("doc_id"), _fingerprints(shingle)(utf8(text_col)).alias("fp")
    )


def grid_cells(fps: DataFrame) -> DataFrame:
    """``(key, fp)``: the twenty grid cells of each fingerprint.

    A cell is named by its three groups and their segments' bit counts as base-3 digits.
    """
    fp, low, signs = F.col("fp"), 0, []
    for bits in GROUP_BITS:
        digits = F.lit(0).cast("long")
        for at in range(low, low + bits, SEGMENT_BITS):
            width = min(SEGMENT_BITS, low + bits - at)
            segment = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            digits = digits * 3 + F.bit_count(segment)
        signs.append(digits.alias(f"s{len(signs)}"))
        low += bits
    size = 3 ** -(-max(GROUP_BITS) // SEGMENT_BITS)
    keys = [
        ((F.lit(n).cast("long") * size + F.col(f"s{i}")) * size + F.col(f"s{j}")) * size + F.col(f"s{k}")
        for n, (i, j, k) in enumerate(combinations(range(len(GROUP_BITS)), 3))
    ]
    return fps.select("fp", *signs).select("fp", F.explode(F.array(*keys)).alias("key"))


_COUNTS = np.array([[(b >> s & 1) + (b >> s + 1 & 1) for s in (0, 2, 4, 6)] for b in range(256)], np.int8)


def embedding(fps: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments of each fingerprint."""
    return _COUNTS[fps.view(np.uint8).reshape(-1, 8)].reshape(-1, 32)


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs are near: the Manhattan bound first, then the exact number of bits."""
    near = np.zeros(len(a), bool)
    for at in range(0, len(a), 1 << 16):
        x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
        below = np.abs(embedding(x) - embedding(y)).sum(axis=1) <= max_bits
        below[below] = np.bitwise_count((x[below] ^ y[below]).view(np.uint64)) <= max_bits
        near[at : at + (1 << 16)] = below
    return near


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning star forest over the positions 0..n-1 that the pairs connect."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if np.array_equal(root, before):
            break
    nodes = np.flatnonzero(root != np.arange(n))
    return nodes, root[nodes]


def link_sorted(cells: np.ndarray, sides: np.ndarray, fps: np.ndarray, max_bits: int):
    """A spanning forest of the near pairs within equal, adjacent cells.

    Rows with different sides of a pair of blocks are compared across only; side -1 stands for
    a block compared with itself.
    """
    n = len(fps)
    heads, tails, held = [], [], 0
    for d in range(1, n):
        at = np.flatnonzero(cells[d:] == cells[:-d])
        if not at.size:
            break
        at = at[(sides[at] < 0) | (sides[at] != sides[at + d])]
        at = at[_near(fps[at], fps[at + d], max_bits)]
        heads.append(at)
        tails.append(at + d)
        held += at.size
        if held > 1 << 18:
            a, b = _forest(np.concatenate(heads), np.concatenate(tails), n)
            heads, tails, held = [a], [b], a.size
    if not heads:
        return fps[:0], fps[:0]
    a, b = _forest(np.concatenate(heads), np.concatenate(tails), n)
    return fps[a], fps[b]


def _link(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "side", "fp")]
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            # The last cell may go on in the next batch.
            others = np.flatnonzero(held[0] != held[0][-1])
            if others.size:
                whole = others[-1] + 1
                yield _edges(*link_sorted(*(x[:whole] for x in held), max_bits))
                held = [x[whole:] for x in held]
        if held is not None:
            yield _edges(*link_sorted(*held, max_bits))

    return run


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that connect all pairs within ``max_bits``.

    ``fps`` holds a fingerprint ``fp`` at most once. ``max_bits`` may be 0 to 3; the grids
    promise nothing beyond.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")
    cells = grid_cells(fps)
    crowded = cells.groupBy("key").agg(F.ceil(F.count("*") / block).alias("blocks")).where("blocks > 1")
    crowded = stored(crowded, "crowded")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.col("other")
    low, high = F.least(own, other), F.greatest(own, other)
    alone = cells.join(crowded, "key", "left_anti").select(
        F.col("key").alias("cell"), F.lit(-1).alias("side"), "fp"
    )
    dealt = (
        cells.join(crowded, "key")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            F.xxhash64("key", low, high).alias("cell"),
            F.when(low == high, -1).otherwise((own == low).cast("int")).alias("side"),
            "fp",
        )
    )
    meeting = alone.unionByName(dealt).repartition("cell").sortWithinPartitions("cell")
    return meeting.mapInArrow(_link(max_bits), "a long, b long").distinct()


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per input row.

    ``component_id`` is the smallest id that a chain of links reaches; texts whose fingerprints
    differ in at most ``max_bits`` bits are linked. Empty and null texts have fingerprint 0 and
    are linked like others. A row with a null id takes part as a text, but never names its
    component, which is null only where no member has an id. Repeated rows are returned as often
    as they come in; an empty table gives an empty result. Other columns are ignored.
    """
    rows = stored(fingerprints(documents, id_col, text_col, shingle), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = connected_components(near_links(distinct.select("fp"), max_bits, block))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp") -> Column:
    """Sixteen lowercase hex digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents less near copies: the row with the smallest id of each component stays.

    Rows with a null id are kept. Rows that repeat an id go together, all if any of their texts is
    a copy of a document with a smaller id.
    """
    (copy,) = free_names(documents, "copy")
    classes = near_duplicates(documents, id_col, text_col)
    copies = classes.where("doc_id <> component_id").select(F.col("doc_id").alias(copy)).distinct()
    return documents.join(copies, F.col(id_col) == F.col(copy), "left_anti")
