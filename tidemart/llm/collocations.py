"""Phrase collocations by vertical partitioning of a depth-truncated suffix tree.

The suffixes are those of every piece of text, by words, cut after four. Prefixes are counted before any
subtree is built: single words exactly, pairs of words under a 64-bit hash. A pair below the least count
has no subtree, as none of its phrases can reach the count. The other pairs are dealt into groups whose
occurrences fit a memory budget; a pair that exceeds its share of a budget is extended, so that its
leaves are dealt out one by one. Each group builds its subtrees on its own: equal leaves are added up, and an inner
node's count is the total of the leaves below it. Only extended pairs have nodes in several groups,
whose parts are added up afterwards.

What tasks must know of the prefixes travels as bit filters of a fixed size. A false positive sends some
leaves that cannot matter, or extends a pair without need, and changes no count.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.tables import stored

DEPTH = 4
LEAST = 30
TOP = 2000
# Candidates inside a longer one that has this share of their occurrences go.
COVERED_PERCENT = 80
# Occurrences per group of subtrees; a pair with more than a quarter of them is extended.
BUDGET = 400_000
# Text that a task cuts into words at a time, ended at a piece's end.
CHUNK_BYTES = 8 << 20
# Each filter has 2 ** FILTER_BITS bits, whatever the size of the data.
FILTER_BITS = 25
UNKNOWN = "und"

_WORD_END, _PIECE_END = 0x20, 0x0A
_BYTES = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 10
)


def _cut(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in parts of about ``size`` bytes that end where a piece ends."""
    at = 0
    while len(data) - at > size:
        end = data.rfind(b"\n", at, at + size)
        end = data.find(b"\n", at + size) if end < 0 else end
        if end < 0:
            break
        yield data[at:end]
        at = end + 1
    yield data[at:]


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, bytes]]:
    """``(lang, text)``: the texts of a language, one after the other, lower-cased, with two separators."""
    held: dict[str, list[bytes]] = {}
    total = 0

    def flushed() -> Iterator[tuple[str, bytes]]:
        for lang, texts in held.items():
            for part in _cut(b"\n".join(texts), size):
                yield lang, part
        held.clear()

    for batch in batches:
        for lang, data in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            held.setdefault(lang, []).append(data.translate(_BYTES))
            total += len(data)
            if total >= size:
                yield from flushed()
                total = 0
    yield from flushed()


class _Words:
    """The words of a chunk as codes into its distinct words."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data, np.uint8)
        ends_piece = raw == _PIECE_END
        inside = ~(ends_piece | (raw == _WORD_END))
        edges = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[inside]))
        encoded = words.dictionary_encode()
        self.distinct = encoded.dictionary
        self.codes = encoded.indices.to_numpy().astype(np.int64)
        piece = np.cumsum(ends_piece, dtype=np.int32)[starts]
        # Whether the next word stands in the same piece; nothing follows the last one.
        self.followed = np.append(piece[1:] == piece[:-1], False)[: len(starts)]

    def hashes(self, lang: str) -> np.ndarray:
        """Of each distinct word the hash that ``F.xxhash64("lang", "word")`` gives."""
        seed = xxhash.xxh64_intdigest(lang.encode(), 42)
        digest = xxhash.xxh64_intdigest
        values = (digest(word, seed) for word in self.distinct.cast(pa.binary()).to_pylist())
        return np.fromiter(values, np.uint64, len(self.distinct))


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes in order."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class BitFilter:
    """A set of 64-bit hashes that may hold more than was put in, never less."""

    def __init__(self, words: np.ndarray):
        self._words, self._mask = words, np.uint64(len(words) * 64 - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in (hashes & self._mask, (hashes >> np.uint64(32)) & self._mask):
            found &= (self._words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def filter_words(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The words of a :class:`BitFilter` of the only column of ``hashes``; ``2 ** (bits - 6)`` longs reach the driver at most."""
    column, mask = F.col(hashes.columns[0]), F.lit((1 << bits) - 1).cast("long")
    places = F.array(column.bitwiseAND(mask), F.shiftrightunsigned(column, 32).bitwiseAND(mask))
    bit = hashes.select(F.explode(places).alias("at"))
    filled = bit.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
    )
    table, words = filled.toArrow(), np.zeros(1 << (bits - 6), np.uint64)
    words[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return words


def _over_chunks(
    documents: DataFrame,
    make: Callable[[str, _Words], pa.RecordBatch | None],
    schema: str,
    size: int,
    text_col: str,
    lang_col: str,
) -> DataFrame:
    """What ``make`` gives for every chunk of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data in _chunks(batches, size):
            words = _Words(data)
            if len(words.codes):
                yield make(lang, words)

    texts = documents.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"),
    )
    return texts.mapInArrow(run, schema)


def _repeated(value: str, n: int) -> pa.Array:
    return pa.DictionaryArray.from_arrays(pa.array(np.zeros(n, np.int32)), [value]).cast(pa.string())


def _word_counts(lang: str, words: _Words) -> pa.RecordBatch:
    """Each distinct word with its number in the chunk; a null word has the number of all."""
    counts = np.bincount(words.codes, minlength=len(words.distinct))
    n = np.append(counts, len(words.codes))
    names = pa.concat_arrays([words.distinct, pa.nulls(1, pa.string())])
    return pa.RecordBatch.from_arrays([_repeated(lang, len(n)), names, pa.array(n)], ["lang", "word", "n"])


def word_counts(
    documents: DataFrame, least: int = LEAST, chunk: int = CHUNK_BYTES, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``(lang, word, n)`` of words with ``least`` occurrences; a null word has the total of the language."""
    parts = _over_chunks(documents, _word_counts, "lang string, word string, n long", chunk, text_col, lang_col)
    summed = parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return summed.where((F.col("n") >= least) | F.col("word").isNull())


class _Links:
    """Which words of a chunk are followed by a word that a phrase can go on with."""

    def __init__(self, lang: str, words: _Words, known: BitFilter):
        hashes = words.hashes(lang)
        frequent = known.has(hashes)[words.codes]
        self.hashes = hashes[words.codes]
        at = np.flatnonzero(words.followed & frequent & np.append(frequent[1:], False))
        self.at, self.pairs = at, _mixed(self.hashes[at], self.hashes[at + 1])


def pair_counts(
    documents: DataFrame,
    known: Broadcast,
    least: int = LEAST,
    chunk: int = CHUNK_BYTES,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``(pair, n)``: hashes of pairs of words that ``known`` has, with ``least`` occurrences or more."""

    def make(lang: str, words: _Words) -> pa.RecordBatch:
        pairs, n = np.unique(_Links(lang, words, BitFilter(known.value)).pairs, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(n)], ["pair", "n"])

    parts = _over_chunks(documents, make, "pair long, n long", chunk, text_col, lang_col)
    return parts.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


_LEAF = "group int, lang string, leaf string, extended boolean, n long"


def _leaves(lang: str, words: _Words, known: BitFilter, pairs: BitFilter, hot: BitFilter, n_groups: int):
    """The chunk's distinct truncated suffixes with their numbers and the group of their prefix."""
    links = _Links(lang, words, known)
    kept = pairs.has(links.pairs)
    at, prefix = links.at[kept], links.pairs[kept]
    linked = np.zeros(len(words.codes) + DEPTH, bool)
    linked[at] = True
    codes = np.append(words.codes, np.full(DEPTH, -1))
    third = np.where(linked[at + 1], codes[at + 2], -1)
    fourth = np.where(linked[at + 1] & linked[at + 2], codes[at + 3], -1)
    width = np.int64(len(words.distinct) + 1)
    head, tail = codes[at] * width + codes[at + 1], (third + 1) * width + fourth + 1
    order = np.lexsort((tail, head))
    head, tail = head[order], tail[order]
    new = np.append(True, (head[1:] != head[:-1]) | (tail[1:] != tail[:-1]))[: len(order)]
    starts = np.flatnonzero(new)
    n, one = np.diff(np.append(starts, len(order))), order[starts]

    columns = [codes[at[one]], codes[at[one] + 1], third[one], fourth[one]]
    names = [pc.take(words.distinct, pa.array(c, mask=c < 0)) for c in columns]
    leaf = pc.binary_join_element_wise(*names, " ", null_handling="skip")
    extended, dealt = hot.has(prefix[one]), prefix[one].copy()
    # The whole leaf decides where the prefix is extended.
    ends = np.append(links.hashes, np.zeros(DEPTH, np.uint64))
    for column, shift in zip(columns[2:], (2, 3), strict=True):
        more = extended & (column >= 0)
        dealt[more] = _mixed(dealt[more], ends[at[one] + shift][more])
    group = ((dealt >> np.uint64(20)) % np.uint64(n_groups)).astype(np.int32)
    arrays = [pa.array(group), _repeated(lang, len(one)), leaf, pa.array(extended), pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, ["group", "lang", "leaf", "extended", "n"])


_NODE = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])


def _subtrees(table: pa.Table, least: int) -> pa.Table:
    """The nodes of a group's subtrees from two words on: a node counts what its leaves add up to."""
    langs = table["lang"].combine_chunks().dictionary_encode()
    split = pc.split_pattern(table["leaf"].combine_chunks(), " ")
    sizes = pc.list_value_length(split).to_numpy()
    flat = split.flatten().dictionary_encode()
    rows = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    codes = np.full((DEPTH, len(sizes)), -1, np.int64)
    codes[place, rows] = flat.indices.to_numpy()
    lang = langs.indices.to_numpy().astype(np.int64)

    width = np.int64(len(flat.dictionary) + 1)
    order = np.lexsort(((codes[2] + 1) * width + codes[3] + 1, codes[0] * width + codes[1], lang))
    codes, lang = codes[:, order], lang[order]
    n, extended = table["n"].to_numpy()[order], table["extended"].to_numpy()[order]
    change = np.append(True, lang[1:] != lang[:-1])
    nodes = []
    for depth in range(1, DEPTH + 1):
        change[1:] |= codes[depth - 1, 1:] != codes[depth - 1, :-1]
        if depth == 1:
            continue
        starts = np.flatnonzero(change)
        totals = np.add.reduceat(n, starts)
        # Below the whole leaf an extended pair has parts of a node in other groups.
        partly = extended[starts] & (depth < DEPTH)
        kept = (codes[depth - 1, starts] >= 0) & (partly | (totals >= least))
        starts, totals = starts[kept], totals[kept]
        names = [pc.take(flat.dictionary, pa.array(codes[i, starts])) for i in range(depth)]
        phrase = pc.binary_join_element_wise(*names, " ")
        of = pc.take(langs.dictionary, pa.array(lang[starts]))
        nodes.append(pa.table([of, phrase, pa.array(np.full(len(starts), depth, np.int32)), pa.array(totals)], schema=_NODE))
    return pa.concat_tables(nodes)


def phrase_counts(
    documents: DataFrame,
    words: DataFrame,
    least: int = LEAST,
    budget: int = BUDGET,
    chunk: int = CHUNK_BYTES,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``(lang, phrase, words, n)``: all phrases of two to four words with ``least`` occurrences or more.

    ``words`` is the stored result of :func:`word_counts`.
    """
    send = documents.sparkSession.sparkContext.broadcast
    # Plain arrays, which need no class of ours where they are unpickled.
    known = send(filter_words(words.where("word is not null").select(F.xxhash64("lang", "word"))))
    pairs = stored(pair_counts(documents, known, least, chunk, text_col, lang_col), "pairs")
    total = pairs.agg(F.sum("n")).first()[0] or 0
    frequent = send(filter_words(pairs.select("pair")))
    hot = send(filter_words(pairs.where(F.col("n") > budget // 4).select("pair")))
    n_groups = max(1, math.ceil(total / budget))

    def make(lang: str, chunk_words: _Words) -> pa.RecordBatch:
        filters = (BitFilter(sent.value) for sent in (known, frequent, hot))
        return _leaves(lang, chunk_words, *filters, n_groups)

    leaves = _over_chunks(documents, make, _LEAF, chunk, text_col, lang_col)
    nodes = leaves.groupBy("group").applyInArrow(
        lambda table: _subtrees(table, least), "lang string, phrase string, words int, n long"
    )
    summed = nodes.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") >= least)


def _exact(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def _slice(start, length) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, length), " ")


def scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(lang, phrase, words, a, l, r, score)``: each phrase at its lowest-scoring cut.

    ``score`` is ``2000000 * a / (l + r)``, rounded down, in exact arithmetic; of equal cuts the first counts.
    """
    single = words.where("word is not null").select("lang", F.col("word").alias("phrase"), "n")
    counts = stored(single.unionByName(phrases.select("lang", "phrase", "n")), "counts")
    cuts = phrases.select(
        "lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    cuts = cuts.withColumn("first", _slice(F.lit(1), F.col("k")))
    cuts = cuts.withColumn("rest", _slice(F.col("k") + 1, F.col("words") - F.col("k")))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    met = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    met = met.withColumn("times", _exact("a") * F.lit(2_000_000).cast("decimal(7,0)"))
    met = met.withColumn("score", F.expr("times div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    best = met.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def uncovered(phrases: DataFrame, candidates: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """The candidates that no longer phrase holds in ``percent`` or more of their occurrences."""
    places = [(start, n) for n in range(2, DEPTH) for start in range(1, DEPTH - n + 2)]
    inner = F.array(*(F.when(F.col("words") >= max(start + n - 1, n + 1), _slice(start, n)) for start, n in places))
    longer = phrases.where("words > 2").select("lang", "n", F.explode(inner).alias("phrase"))
    longest = longer.where("phrase is not null").groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    covered = _exact("around") * 100 >= _exact("a") * percent
    met = candidates.join(longest, ["lang", "phrase"], "left")
    return met.where(F.col("around").isNull() | ~covered).drop("around")


def collocations(
    documents: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    budget: int = BUDGET,
    chunk: int = CHUNK_BYTES,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The ``top`` phrases of two to four words per language, by score, occurrences and text.

    Returns ``lang, rank, phrase, a, l, r, n, score``. Texts are lower-cased (A-Z), cut into pieces at
    punctuation and line ends and these into words at blanks and tabs; ``n`` counts all words of the language. Null
    texts are empty, a null language is ``und``. Repeated rows count as often as they come. A text of any
    length is read whole, in chunks that end with a piece; a single piece is held in one task. Rows of equal
    score and occurrences follow the bytes of their phrase. Empty texts and an empty table give no rows. Other
    columns are ignored.
    """
    columns = {"chunk": chunk, "text_col": text_col, "lang_col": lang_col}
    words = stored(word_counts(documents, least, **columns), "words")
    phrases = stored(phrase_counts(documents, words, least, budget, **columns), "phrases")
    kept = uncovered(phrases, scored(words, phrases))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = words.where("word is null").select("lang", "n")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
