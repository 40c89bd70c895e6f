"""``ntile`` over a whole table without gathering it in one partition."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from tidemart.session import scratch_path

# monotonically_increasing_id keeps the partition number above this bit.
_ROW_BITS = 33


def _bucket(rank: Column, total: int, buckets: int) -> Column:
    """Bucket of a 1-based rank: the first ``total % buckets`` buckets hold one row more."""
    size, larger = divmod(total, buckets)
    boundary = larger * (size + 1)
    in_larger = F.floor((rank - 1) / (size + 1)) + 1
    in_smaller = F.floor((rank - 1 - boundary) / max(size, 1)) + 1 + larger
    return F.when(rank <= boundary, in_larger).otherwise(in_smaller).cast("int")


def ntile_scores(
    df: DataFrame, key: str, scores: Mapping[str, tuple[str, bool]], buckets: int
) -> DataFrame:
    """Add one ntile column per entry of ``scores``: output name -> (column, ascending).

    ``key`` must be unique; it breaks ties, which makes every score reproducible and lets
    the range partitioning cut through a value that many rows share. The score columns
    must be integers or decimals with at most two decimals, other types are refused; nulls rank
    last either way.

    All scores are ranked by one range-partitioned sort. Row positions are fixed by writing
    them to the scratch folder, a job that runs while the result is being planned; one count per
    partition (never per row) reaches the driver to turn positions inside a partition into global
    ranks. The result reads that table, so it stays until the cluster clears the folder.
    """
    names = list(scores)
    for column in {column for column, _ in scores.values()}:
        kind = df.schema[column].dataType
        exact = isinstance(kind, IntegralType) or (
            isinstance(kind, DecimalType) and kind.scale <= 2 and kind.precision - kind.scale <= 36
        )
        if not exact:
            raise ValueError(f"{column} is {kind.simpleString()}, which cannot be ranked exactly")
    value_columns = {column for column, _ in scores.values()}
    carried = [c for c in df.columns if c != key and c not in value_columns]
    if carried:
        raise ValueError(f"ntile_scores only carries the key and score columns, not {carried}")

    def sortable(column: str, ascending: bool) -> Column:
        value = F.col(column).cast("decimal(38,2)")
        return value if ascending else -value

    entries = [
        F.struct(F.lit(i).alias("which"), sortable(*scores[name]).alias("value"))
        for i, name in enumerate(names)
    ]
    placed = (
        df.select(key, F.inline(F.array(*entries)))
        .orderBy("which", F.col("value").asc_nulls_last(), key)
        .withColumn("position", F.monotonically_increasing_id())
    )
    path = scratch_path(df.sparkSession, "ranked")
    placed.write.parquet(path)
    placed = df.sparkSession.read.schema(placed.schema).parquet(path)
    part = F.shiftright("position", _ROW_BITS).cast("int")
    counts = sorted(
        (row["part"], row["count"]) for row in placed.groupBy(part.alias("part")).count().collect()
    )
    ends = list(accumulate(count for _, count in counts))
    total = (ends[-1] if ends else 0) // len(names)
    starts = df.sparkSession.createDataFrame(
        [(part_id, end - count) for (part_id, count), end in zip(counts, ends)],
        "part int, start bigint",
    )
    row_in_part = F.col("position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    rank = F.col("start") + row_in_part + 1 - F.col("which") * F.lit(total)
    bucketed = (
        placed.withColumn("part", part)
        .join(F.broadcast(starts), "part")
        .withColumn("bucket", _bucket(rank, total, buckets))
    )

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("which") == names.index(name), F.col(column)))

    originals = []
    for column in (c for c in df.columns if c in value_columns):
        name = next(n for n in names if scores[n][0] == column)
        value = of(name, "value") if scores[name][1] else -of(name, "value")
        originals.append(value.cast(df.schema[column].dataType).alias(column))
    return bucketed.groupBy(key).agg(*originals, *[of(n, "bucket").alias(n) for n in names])
