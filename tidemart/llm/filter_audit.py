"""Filter interaction audit: what each filter removes in every order of the filters.

A document is reduced to a mask of the filters it fails, and documents to weighted mask cells, of which
a part of the corpus has at most two to the number of filters. Each cell is folded across the array of all
orders: one weighted struct per order and step. The structs of a part's cells are merged by elementwise
sums. Texts are read once and never shuffled; only hashes, ids and masks are.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.operators.skew import splittable_join

Condition = Callable[[Column], Column]

WORD = r"[^\x20\x09-\x0D]+"
# Orders grow with the factorial of the filters; six of them have 720 orders of six steps.
MOST_FILTERS = 6
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


# Failure conditions by letter, of a text that is never null.
CONDITIONS: dict[str, Condition] = {
    "A": lambda text: F.size(words(text)) < 200,
    "B": lambda text: 100 * F.size(F.array_distinct(words(text))) < 50 * F.size(words(text)),
    "C": lambda text: 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 3 * F.char_length(text),
    "D": lambda text: text.rlike(r"[#$%&*|]"),
}
# The letter of the filter on texts that a smaller id holds too.
REPEATED = "E"


def _masks(documents: DataFrame, conditions: Mapping[str, Condition], id_col: str, text_col: str, part_col: str):
    """One small row per document: id, part, two hashes of the text, mask of the conditions it fails."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    bits = [F.when(fails(F.col("text")), 1 << i).otherwise(0) for i, fails in enumerate(conditions.values())]
    return rows.select(
        "doc_id",
        "part",
        F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit(1), F.col("text")).alias("h2"),
        sum(bits, F.lit(0)).alias("mask"),
    )


def _marks(labels: DataFrame, id_col: str) -> DataFrame:
    """One row per labelled id; a mark holds if any row of the id says so."""
    return labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
    )


def mask_cells(
    documents: DataFrame,
    labels: DataFrame,
    conditions: Mapping[str, Condition] = CONDITIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by the set of filters they fail.

    Bit ``i`` of the mask is the ``i``-th condition, the bit after the last one is set if a smaller id
    holds the same text. Copies of a text are added up per cell before their hash is shuffled, so a text
    that very many documents share brings a few rows to its task.
    """
    rows = _masks(documents, conditions, id_col, text_col, part_col)
    marked = splittable_join(rows, _marks(labels, id_col), ["doc_id"], "left").fillna(0, ["good", "toxic"])
    cell = ["h1", "h2", "part", "mask", "good", "toxic"]
    by_id = marked.groupBy(*cell, "doc_id").agg(F.count("*").alias("n"))
    # Rows without an id come last and are no copy of any other.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "n"))
    unnamed = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0))
    copies = by_id.groupBy(*cell).agg(F.sum("n").alias("n"), least.alias("least"), unnamed.alias("unnamed"))
    # One row per text, part and mark is left.
    first = F.min("least.doc_id").over(Window.partitionBy("h1", "h2"))
    counted = copies.withColumn("first", first)
    own = F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    stay = F.col("unnamed") + own
    split = F.array(
        F.struct(F.col("mask").alias("mask"), stay.alias("n")),
        F.struct((F.col("mask") + (1 << len(conditions))).alias("mask"), (F.col("n") - stay).alias("n")),
    )
    cells = counted.select("part", "good", "toxic", F.inline(split)).where("n > 0")
    return cells.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )


# A cell folded along one order: `seen` has the bits of the filters so far.
_FOLD = """
    flatten(transform(orders, steps -> aggregate(
        steps,
        named_struct('seen', 0, 'out', cast(array() as array<struct<
            kept: bigint, removed: bigint, redundant: bigint,
            unique_fails: bigint, good_lost: bigint, toxic_lost: bigint>>)),
        (state, bit) -> named_struct(
            'seen', state.seen | bit,
            'out', concat(state.out, array(named_struct(
                'kept', if(mask & (state.seen | bit) = 0, n, 0L),
                'removed', if(mask & bit <> 0 and mask & state.seen = 0, n, 0L),
                'redundant', if(mask & bit <> 0 and mask & state.seen <> 0, n, 0L),
                'unique_fails', if(mask = bit, n, 0L),
                'good_lost', if(mask & bit <> 0 and mask & state.seen = 0, good, 0L),
                'toxic_lost', if(mask & bit <> 0 and mask & state.seen = 0, toxic, 0L))))),
        state -> state.out)))
"""
_ZEROS = ", ".join(f"'{c}', 0L" for c in COUNTS)
_SUMS = ", ".join(f"'{c}', a.{c} + b.{c}" for c in COUNTS)
_MERGE = f"""
    aggregate(collect_list(folded), array_repeat(named_struct({_ZEROS}), size(first(folded))),
        (total, one) -> zip_with(total, one, (a, b) -> named_struct({_SUMS})))
"""
# By filter, in order of its bit: its removals over all orders at any step.
_SHAPLEY = """
    transform(sequence(0, {last}), i -> aggregate(
        zip_with(totals, flatten(orders), (t, bit) -> if(bit = shiftleft(1, i), t.removed, 0L)),
        0L, (sum, x) -> sum + x))
"""


def audit(cells: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from the cells of :func:`mask_cells`.

    ``letters`` names the filters in the order of their bits. Returns ``part, filter_order, step`` and long
    counts: ``kept`` after the step, ``removed`` at it, ``redundant`` (fails the step's filter, removed
    before), ``unique_fails`` (fails that filter only), ``good_lost`` and ``toxic_lost`` among the removed,
    ``shapley`` (the filter's removals summed over all orders). Parts without a cell have no row.
    """
    if not 1 <= len(letters) <= MOST_FILTERS or len(set(letters)) != len(letters):
        raise ValueError(f"one to {MOST_FILTERS} filters of different names")
    names = ["".join(order) for order in permutations(letters)]
    bits = [[1 << letters.index(letter) for letter in name] for name in names]
    orders = F.from_json(F.lit(json.dumps(bits)), "array<array<int>>")
    named = F.from_json(F.lit(json.dumps(names)), "array<string>")
    folded = cells.withColumn("orders", orders).select("part", F.expr(_FOLD).alias("folded"))
    merged = folded.groupBy("part").agg(F.expr(_MERGE).alias("totals")).withColumn("orders", orders)
    shares = merged.withColumn("shares", F.expr(_SHAPLEY.format(last=len(letters) - 1)))
    steps = shares.select("part", "shares", F.posexplode("totals").alias("at", "counts"))
    order, step = F.floor(F.col("at") / len(letters)).cast("int"), F.col("at") % len(letters)
    name = F.get(named, order)
    letter = F.instr(F.lit(letters), F.substring(name, step + 1, F.lit(1))) - 1
    return steps.select(
        "part",
        name.alias("filter_order"),
        (step + 1).cast("int").alias("step"),
        *(F.col(f"counts.{c}").alias(c) for c in COUNTS),
        F.get("shares", letter).alias("shapley"),
    )


def audit_documents(documents: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The audit of the five filters A to E over all documents, by part.

    Null texts are empty, a null part is the empty string. A document without an id neither fails E nor makes
    another fail it; rows that share the smallest id of a text all pass E. Marks of an id that several
    label rows have hold if any says so; ids without a label have none. Whatever the length of a text, it is
    read whole. An empty table gives an empty result; other columns are ignored.
    """
    return audit(mask_cells(documents, labels, **columns), "".join(CONDITIONS) + REPEATED)
