"""Removal of lines that an earlier document holds, as per-document keep bitmaps.

Line keys are hashed and range-partitioned by hash and block of document ids, then sorted by
document and position within each partition. A line goes exactly when its key was seen in a
smaller document, so one running "first document" per key decides it while the rows stream by.
A key that many documents hold is cut into blocks of ids, so no task gets all its lines; one row
per key then says which block is the key's first. Only dropped positions are
gathered per document, 64 lines to a long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.tables import free_names, stored
from tidemart.operators.skew import splittable_join

MIN_CODE_POINTS = 10
# A key's lines are cut every 2 ** BLOCK_BITS ids, so a task holds at most that many documents of it.
BLOCK_BITS = 12
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text_col: str | Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased and nothing else."""
    stripped = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(stripped) == F.char_length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(F.translate(stripped, UPPER, LOWER))


def _hashed_lines(documents: DataFrame, id_col: str, text_col: str, shortest: int) -> DataFrame:
    """One row per line that counts: two 64-bit hashes of its key, document, text hash, position."""
    rows = documents.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.posexplode(lines_of(text_col)).alias("pos", "line"),
    )
    keyed = rows.where(F.char_length("line") >= shortest).withColumn("key", line_key(F.col("line")))
    return keyed.where(F.char_length("key") >= shortest).select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
        F.shiftright("doc", BLOCK_BITS).alias("block"),
        "doc",
        "text_hash",
        "pos",
    )


def dropped_lines(lines: DataFrame) -> DataFrame:
    """The rows of ``lines`` whose key a document with a smaller id holds too."""
    key = ["h1", "h2"]
    ranged = lines.repartitionByRange(*key, "block").sortWithinPartitions(*key, "block", "doc", "pos")
    so_far = Window.partitionBy(*key, "block").orderBy("doc", "pos")
    running = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    streamed = ranged.withColumn("first_doc", F.first("doc").over(running))
    # Where ids are far apart every document is a block of its own, so a key's first block is found by an
    # aggregate that each task reduces, and joined so that a key with very many lines is split.
    blocks = lines.groupBy(*key).agg(F.min("block").alias("first_block"), F.max("block").alias("last_block"))
    spread = blocks.where("first_block < last_block").drop("last_block")
    decided = splittable_join(streamed, spread, key, "left")
    return decided.where("block > first_block or doc > first_doc").select("doc", "text_hash", "pos")


def _bitmaps(dropped: DataFrame) -> DataFrame:
    """Per document the keep bits, 64 lines to a long, up to the last long with a dropped line."""
    document = ["doc", "text_hash"]
    at = Window.partitionBy(*document).orderBy("word")
    words = (
        dropped.repartition(*document)
        .groupBy(*document, F.floor(F.col("pos") / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("gone"))
        .withColumn("gap", F.col("word") - F.coalesce(F.lag("word").over(at), F.lit(-1)) - 1)
    )
    all_kept = F.array_repeat(F.lit(-1).cast("long"), F.col("gap"))
    run = F.concat(all_kept, F.array(F.bitwise_not("gone")))
    return (
        words.groupBy(*document)
        .agg(
            F.array_sort(F.collect_list(F.struct("word", run.alias("run")))).alias("runs"),
            F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"),
        )
        .select(*document, F.flatten(F.col("runs.run")).alias("keep"), "n_dropped")
    )


def keep_bitmaps(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = MIN_CODE_POINTS
) -> DataFrame:
    """``(doc, text_hash, keep, n_dropped)`` for every document that loses a line.

    Bit ``i % 64`` of ``keep[i / 64]`` is 1 if line ``i`` stays; lines beyond the array stay. A line
    goes if its key has at least ``shortest`` code points and a document with a smaller id holds
    the key. Rows with a null id keep all lines and take none from others; rows that share an id
    are one document, so they take no lines from each other. Null and empty texts are one empty
    line. Keys are told apart by 128 bits of hash. An empty table gives an empty result.
    """
    lines = stored(_hashed_lines(documents, id_col, text_col, shortest), "lines")
    return _bitmaps(dropped_lines(lines))


def kept_text(text_col: str | Column, keep: Column) -> Column:
    """The text less the lines that its bitmap drops; a null bitmap drops none."""
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    stays = lambda line, i: F.getbit(
        F.coalesce(F.get(keep, F.floor(i / 64).cast("int")), F.lit(-1).cast("long")), i % 64
    ) == F.lit(1)
    return F.when(keep.isNull(), text).otherwise(F.array_join(F.filter(lines_of(text), stays), "\n"))


def with_bitmaps(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, Column, Column]:
    """The documents beside their bitmaps; the columns of the bitmap and of the lines it drops, or null."""
    names = free_names(documents, "doc", "text_hash", "keep", "n_dropped")
    doc, text_hash, keep, n_dropped = names
    bitmaps = keep_bitmaps(documents, id_col, text_col).toDF(*names)
    same = F.col(id_col).cast("long") == F.col(doc)
    same &= F.xxhash64(F.col(text_col)) == F.col(text_hash)
    return documents.join(bitmaps, same, "left"), F.col(keep), F.col(n_dropped)


def without_repeated_lines(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None
) -> DataFrame:
    """The documents with the lines dropped; a null text stays null, other columns as they are.

    ``chars_col`` names a column with the length of the text, which then follows the text.
    """
    joined, keep, _ = with_bitmaps(documents, id_col, text_col)
    kept = joined.withColumn(text_col, kept_text(text_col, keep))
    if chars_col:
        length = F.char_length(text_col).cast(documents.schema[chars_col].dataType)
        kept = kept.withColumn(chars_col, F.when(keep.isNull(), F.col(chars_col)).otherwise(length))
    return kept.select(*documents.columns)
