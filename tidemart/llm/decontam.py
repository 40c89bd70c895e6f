"""Benchmark decontamination: q-gram lemma filter over diagonal bands, then banded alignment.

Texts and items are normalised to lower-case letters and digits with single spaces. Two strings
within ``k`` edits, one of them ``m`` long, share at least ``m + 1 - q * (k + 1)`` of its q-grams,
and those lie on diagonals (place in the text less place in the item) at most ``k`` apart. So the
shared q-grams of an item are counted in bands of diagonals that overlap by half. A region stays if
enough different q-grams of the item fall within one window of it, and a window of each region is
then aligned to the text within the band.

Items too short for an edit by that bound are compared whole: from ``Q`` characters on anywhere in the
text, shorter ones as whole words, and items of symbols only as whole runs of symbols as written.

The items are sent to all tasks, in blocks of bounded size: a larger benchmark takes several
passes over the documents. Documents of any length are read a slab at a time.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import free_names, stored

Q = 8
WINDOW = 120
EDITS = 10
# Least normalised characters of an item that is searched for; up to 1, items of symbols only are too.
SHORTEST_ITEM = 1
# Characters of items that are sent to a task at once.
BLOCK_CHARS = 4_000_000

SLAB = 1 << 19
BLOOM_BITS = 22
SPACE = np.uint32(32)
# Shared q-grams that are held at once.
MOST_HITS = 1 << 22
# Stands between the documents of a slab; never part of a text.
GAP = np.uint32(0xFFFFFFFF)
# The same between two parts of one text, where no word ends.
CUT = np.uint32(0xFFFFFFFE)
# What normalises to spaces, and the runs of symbols in it.
_UNWORDED = re.compile(r"(?:[^\w\U00010000-\U0010ffff]|_)+")
_SYMBOLS = re.compile(r"\S+")


def _folding() -> np.ndarray:
    """For each code point of the first plane its lower case, or a space if no letter or digit."""
    table = np.full(1 << 16, SPACE, np.uint32)
    for point in range(1 << 16):
        char = chr(point)
        if char.isalnum():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def normalised(text: str, folding: np.ndarray, after_space: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters with single spaces between words; each one's place in the text.

    A space in front is left out where a space came before the text.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = np.where(points < 1 << 16, folding[points & 0xFFFF], points)
    space = folded == SPACE
    before = np.concatenate([[after_space], space[:-1]])[: len(space)]
    places = np.flatnonzero(~(space & before))
    return folded[places], places


def qgram_hashes(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit polynomial hash of the q-gram at each place; ``q`` is a power of two."""
    hashes, base, width = chars.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    while width < q:
        hashes = hashes[:-width] * np.uint64(pow(base, width, 1 << 64)) + hashes[width:]
        width *= 2
    return hashes * np.uint64(0xD6E8FEB86659FD93)


def word_hashes(words: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each row of characters."""
    hashes = np.zeros(len(words), np.uint64)
    for column in words.T:
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) + np.uint64(1)
    return hashes


def _entries(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The entries from each ``first`` on, ``n`` of them."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


class Items:
    """Searchable benchmark items: their q-grams sorted by hash, and a bit map in front of them."""

    def __init__(self, items: list[tuple[int, str]], window: int, edits: int, shortest: int):
        self.folding = _folding()
        self.ids, self.chars = [], []
        # Items of symbols by their first run.
        self.symbols: defaultdict[str, list[tuple[int, list[str]]]] = defaultdict(list)
        for item_id, text in items:
            chars = normalised(text or "", self.folding)[0]
            if len(chars) and chars[-1] == SPACE:
                chars = chars[:-1]
            if not len(chars) and shortest <= 1 and (runs := _SYMBOLS.findall(text or "")):
                self.symbols[runs[0]].append((len(self.ids), runs))
            elif not len(chars) or len(chars) < shortest:
                continue
            self.ids.append(item_id)
            self.chars.append(chars)
        lengths = np.array([len(c) for c in self.chars], np.int64)
        self.window = np.minimum(lengths, window)
        # No more edits than the lemma bounds: one below 16 characters could leave no shared q-gram.
        self.edits = np.clip(np.minimum(self.window * edits // window, self.window // Q - 1), 0, None)
        self.needed = np.maximum(1, self.window + 1 - Q * (self.edits + 1))
        self.whole = (self.edits == 0) & (lengths <= window)
        self.words: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in range(1, Q):
            short = np.flatnonzero(lengths == length)
            if len(short):
                hashes = word_hashes(np.stack([self.chars[one] for one in short]))
                order = np.argsort(hashes, kind="stable")
                self.words[length] = hashes[order], short[order]
        self.band = int(edits) + 1
        self.overlap = max(window + 2 * edits, 2 * Q)
        none = np.zeros(0, np.uint64)
        # An item that is compared whole is found by its first q-gram.
        grams = [
            none if len(c) < Q else qgram_hashes(c[:Q] if whole else c)
            for c, whole in zip(self.chars, self.whole, strict=True)
        ]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.place = hashes[order], item[order], place[order]
        self.bloom = np.zeros(1 << BLOOM_BITS, bool)
        self.bloom[self.hashes >> np.uint64(64 - BLOOM_BITS)] = True

    def lookup(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of a text whose q-gram some item has: the place, the first such entry, how many."""
        if len(chars) < Q or not len(self.hashes):
            return (np.zeros(0, np.int64),) * 3
        hashes = qgram_hashes(chars)
        at = np.flatnonzero(self.bloom[hashes >> np.uint64(64 - BLOOM_BITS)])
        first = np.searchsorted(self.hashes, hashes[at])
        return at, first, np.searchsorted(self.hashes, hashes[at], side="right") - first

    def regions(
        self, at: np.ndarray, first: np.ndarray, n: np.ndarray
    ) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(item, lowest diagonal of the band, first places in the item)`` that meet the bound."""
        if not n.sum():
            return
        entry, at = _entries(first, n), np.repeat(at, n)
        partly = ~self.whole[self.item[entry]]
        entry, at = entry[partly], at[partly]
        item, place = self.item[entry], self.place[entry]
        diagonal = at - place
        for shift in (0, self.band):
            band = (diagonal + shift) // (2 * self.band)
            key = band * len(self.ids) + item
            # Few bands get more than a hit or two; only those with enough are sorted.
            _, where, size = np.unique(key, return_inverse=True, return_counts=True)
            enough = np.flatnonzero(size[where] >= self.needed[item])
            if not len(enough):
                continue
            rows = np.unique(np.stack([key[enough], place[enough]], axis=1), axis=0)
            starts = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
            for low, high in zip(starts, np.append(starts[1:], len(rows)), strict=True):
                one, of_band = int(rows[low, 0] % len(self.ids)), int(rows[low, 0] // len(self.ids))
                places, need = rows[low:high, 1], int(self.needed[one])
                if len(places) >= need:
                    spans = places[need - 1 :] - places[: len(places) - need + 1]
                    within = places[: len(spans)][spans <= self.window[one] - Q]
                    if len(within):
                        yield one, of_band * 2 * self.band - shift, within

    def whole_items(
        self, chars: np.ndarray, at: np.ndarray, first: np.ndarray, n: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """``(items, places)`` of the items from ``Q`` characters on that are compared whole."""
        if not (self.whole & (self.window >= Q)).any() or not n.sum():
            return (np.zeros(0, np.int64),) * 2
        entry, at = _entries(first, n), np.repeat(at, n)
        whole = self.whole[self.item[entry]]
        item, at = self.item[entry[whole]], at[whole]
        kept = [(np.zeros(0, np.int64),) * 2]
        for one in np.unique(item):
            mine, text = at[item == one], self.chars[one]
            mine = mine[mine + len(text) <= len(chars)]
            for i, char in enumerate(text):
                mine = mine[chars[mine + i] == char]
            kept.append((np.full(len(mine), one), mine))
        items, places = zip(*kept, strict=True)
        return np.concatenate(items), np.concatenate(places)

    def whole_words(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(items, places)`` of the items below ``Q`` characters that stand as whole words."""
        kept = [(np.zeros(0, np.int64),) * 2]
        if self.words:
            ends = (chars == SPACE) | (chars == GAP)
            starts = np.flatnonzero(ends[:-1] & ~ends[1:]) + 1
            for length, (hashes, short) in self.words.items():
                mine = starts[starts + length < len(chars)]
                mine = mine[ends[mine + length]]
                words = chars[mine[:, None] + np.arange(length)]
                hashed = word_hashes(words)
                first = np.searchsorted(hashes, hashed)
                n = np.searchsorted(hashes, hashed, side="right") - first
                items, nth = short[_entries(first, n)], np.repeat(np.arange(len(mine)), n)
                texts = np.stack([self.chars[one] for one in short])[_entries(first, n)]
                same = (texts == words[nth]).all(axis=1)
                kept.append((items[same], mine[nth[same]]))
        items, places = zip(*kept, strict=True)
        return np.concatenate(items), np.concatenate(places)

    def symbol_runs(self, text: str) -> Iterator[tuple[int, int, int]]:
        """``(item, start, end)`` of the items of symbols only, in code points of the text."""
        for between in _UNWORDED.finditer(text) if self.symbols else ():
            runs = list(_SYMBOLS.finditer(between[0]))
            for nth, run in enumerate(runs):
                for one, wanted in self.symbols.get(run[0], ()):
                    last = nth + len(wanted) - 1
                    if last < len(runs) and all(r[0] == w for r, w in zip(runs[nth:], wanted, strict=False)):
                        yield one, between.start() + run.start(), between.start() + runs[last].end()

    def aligned(
        self, chars: np.ndarray, one: int, lowest: int, starts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """``(edits, end in the text)`` of each alignment of the item's windows at ``starts`` that
        keeps to the edit budget.

        After ``i`` characters of a window, ``cost[b]`` is for ``i + b`` characters of the text from
        the band's first place on; the alignment may begin and end anywhere in the band.
        """
        width, k = int(self.window[one]), int(self.edits[one])
        span = 2 * self.band + 2 * k
        windows = self.chars[one][starts[:, None] + np.arange(width)]
        places = starts[:, None] + lowest - k + np.arange(width + span)
        inside = (places >= 0) & (places < len(chars))
        text = np.where(inside, chars[np.clip(places, 0, len(chars) - 1)], GAP)
        steps = np.arange(span + 1, dtype=np.int32)
        cost = np.zeros((len(starts), span + 1), np.int32)
        for i in range(width):
            new = cost + (text[:, i : i + span + 1] != windows[:, i : i + 1])
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(new - steps, axis=1) + steps
        window, b = np.nonzero(cost <= k)
        return cost[window, b], starts[window] + lowest - k + width + b

    def search(self, chars: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """``(item, edits, start, end)`` of a window within its edit budget, for each region and each
        part of the slab in it with one, and of the items that are compared whole.

        Where a text shares very many q-grams, its halves are searched, overlapping by more than a
        window with its edits.
        """
        found = self.lookup(chars)
        if found[2].sum() > MOST_HITS and len(chars) > 4 * self.overlap:
            middle = len(chars) // 2
            cut = np.full(1, CUT)
            yield from self.search(np.append(chars[: middle + self.overlap], cut))
            for one, edits, start, end in self.search(chars[middle:]):
                yield one, edits, start + middle, end + middle
            return
        part = np.cumsum(chars >= CUT)
        for items, places in (self.whole_items(chars, *found), self.whole_words(chars)):
            # Once for each part of the slab that holds the item.
            _, once = np.unique(part[places] * len(self.ids) + items, return_index=True)
            for one, start in zip(items[once].tolist(), places[once].tolist(), strict=True):
                yield one, 0, start, start + len(self.chars[one])
        inside = np.concatenate([[False], chars < CUT, [False]])
        heads, tails = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        for one, lowest, firsts in self.regions(*found):
            width, last = int(self.window[one]), len(self.chars[one]) - int(self.window[one])
            # The window of a region may start before the first q-gram that it shares.
            slack = max(0, width - Q - int(self.needed[one]) + 1)
            near = np.zeros(last + 2, np.int64)
            np.add.at(near, np.clip(firsts - slack, 0, last), 1)
            np.add.at(near, np.minimum(firsts, last) + 1, -1)
            every, likely = np.flatnonzero(np.cumsum(near)[:-1]), np.minimum(firsts[:1], last)
            k, done = int(self.edits[one]), np.zeros(0, np.int64)
            for starts in (likely, *(every[at : at + 256] for at in range(0, len(every), 256))):
                if len(done):
                    # On to the windows whose text may lie in other parts.
                    low = np.searchsorted(tails, starts + lowest + width - 2 * k)
                    high = np.searchsorted(heads, starts + lowest + 2 * self.band + 2 * k, side="right")
                    found_in = np.searchsorted(done, high) - np.searchsorted(done, low)
                    starts = starts[high - low > found_in]
                    if not len(starts):
                        continue
                edits, ends = self.aligned(chars, one, lowest, starts)
                nth = np.searchsorted(heads, ends - 1, side="right") - 1
                order = np.argsort(edits, kind="stable")
                parts, best = np.unique(nth[order], return_index=True)
                for at in order[best[~np.isin(parts, done)]]:
                    yield one, int(edits[at]), int(ends[at]) - width, int(ends[at])
                done = np.union1d(done, parts)


class Slab:
    """Normalised texts of several rows, or a part of a long one, kept apart by more gaps than edits."""

    def __init__(self, items: Items):
        self.items, self.gap = items, np.full(items.band, GAP, np.uint32)
        self.cut = np.full(items.band, CUT, np.uint32)
        self.found: dict[tuple[int, int], tuple[int, int, int]] = {}
        self._reset()

    def _reset(self) -> None:
        self.parts, self.rows, self.starts, self.places, self.size = [], [], [], [], 0

    def add(self, row: int, text: str) -> None:
        """Take in a row's text, searching whenever a slab is full."""
        for one, start, end in self.items.symbol_runs(text):
            self._keep(row, one, (0, start, end))
        tail, tail_places = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for at in range(0, len(text), SLAB):
            ended = not len(tail) or tail[-1] == SPACE
            chars, places = normalised(text[at : at + SLAB], self.items.folding, ended)
            chars, places = np.concatenate([tail, chars]), np.concatenate([tail_places, places + at])
            after = self.gap if at + SLAB >= len(text) else self.cut
            self.parts += [self.cut if at else self.gap, chars, after]
            self.rows.append(row)
            self.starts.append(self.size + len(self.gap))
            self.places.append(places)
            self.size += 2 * len(self.gap) + len(chars)
            tail, tail_places = chars[-self.items.overlap :], places[-self.items.overlap :]
            if self.size >= SLAB:
                self.flush()

    def flush(self) -> None:
        if self.parts:
            starts = np.array(self.starts)
            for one, edits, start, end in self.items.search(np.concatenate(self.parts)):
                nth = max(0, int(np.searchsorted(starts, end - 1, side="right")) - 1)
                places = self.places[nth]
                if not len(places):
                    continue
                low, high = max(0, start - self.starts[nth]), min(len(places), end - self.starts[nth])
                match = edits, int(places[min(low, len(places) - 1)]), int(places[max(0, high - 1)]) + 1
                self._keep(self.rows[nth], one, match)
        self._reset()

    def _keep(self, row: int, one: int, match: tuple[int, int, int]) -> None:
        self.found[row, one] = min(match, self.found.get((row, one), match))


_LEAK = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("item_id", pa.int64()),
        ("edits", pa.int64()),
        ("start", pa.int64()),
        ("end", pa.int64()),
    ]
)


def _searched(
    texts: DataFrame, block: list[tuple[int, str]], window: int, edits: int, shortest: int
) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(sent.value, window, edits, shortest)
        for batch in batches:
            slab = Slab(items)
            for row, text in enumerate(batch.column(2).to_pylist()):
                slab.add(row, text or "")
            slab.flush()
            rows = np.array([row for row, _ in slab.found], np.int64)
            named = [[items.ids[one] for _, one in slab.found], *zip(*slab.found.values(), strict=True)]
            arrays = [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))]
            if not slab.found:
                named = [[]] * 4
            arrays += [pa.array(column, pa.int64()) for column in named]
            yield pa.RecordBatch.from_arrays(arrays, schema=_LEAK)

    return texts.mapInArrow(
        run, "doc_id long, text_hash long, item_id long, edits long, start long, end long"
    )


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most so many characters, or of one longer item."""
    block, size = [], 0
    for item_id, text in items.toLocalIterator():
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield block


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    edits: int = EDITS,
    shortest: int = SHORTEST_ITEM,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``(doc_id, text_hash, item_id, edits, start, end)``, one row per document text and item in it.

    A document holds an item if some window of ``window`` normalised characters of the item is
    within ``edits`` edits of a part of the text; of a shorter item it is the whole, with
    proportionally fewer edits, none below 16 characters. Items below 8 characters count as whole words
    only, and items of symbols only as whole runs of symbols as written. ``start`` and ``end`` are code
    points of the text around the window with the fewest edits that was found. Items that are null, or
    blank, or below ``shortest`` normalised characters, are not searched for. Null and empty texts hold nothing. Repeated rows give one row; a row with a
    null id is reported under the null id. An empty table on either side gives an empty result. Other
    columns are ignored.
    """
    if window + 1 - Q * (edits + 1) < 1:
        raise ValueError("the q-gram lemma bounds nothing for so many edits in so short a window")
    texts = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    items = items.where("text is not null")
    items, found, block = items.distinct(), [], None
    # A block's items reach the tasks as one broadcast. Where another follows, its pass is written first.
    for following in _blocks(items, block_chars):
        if block is not None:
            found.append(stored(_searched(texts, block, window, edits, shortest), "leaks"))
        block = following
    found.append(_searched(texts, block or [], window, edits, shortest))
    found = reduce(DataFrame.unionByName, found)
    best = F.min(F.struct("edits", "start", "end")).alias("best")
    return found.groupBy("doc_id", "text_hash", "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", "best.edits", "best.start", "best.end"
    )


def leaks_per_item(found: DataFrame) -> DataFrame:
    """``(item_id, n_texts, n_exact)`` of the leaks found: what each benchmark item costs the corpus.

    Look at it before :func:`without_leaks`: an item of one common word is held by very many documents.
    """
    exact = F.count(F.when(F.col("edits") == 0, 1))
    return found.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_texts"), exact.alias("n_exact"))


def without_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST_ITEM,
) -> DataFrame:
    """The documents that hold no benchmark item; a row is told by its id and its text.

    Items below ``shortest`` normalised characters are not searched for; by default all are.
    """
    doc, text_hash = free_names(documents, "doc", "text_hash")
    found = leaks(documents, benchmark, id_col, text_col, shortest=shortest)
    held = found.select("doc_id", "text_hash").distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col(doc))
    same &= F.xxhash64(F.col(text_col)) == F.col(text_hash)
    return documents.join(held.toDF(doc, text_hash), same, "left_anti")
