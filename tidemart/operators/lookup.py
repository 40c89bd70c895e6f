"""Rows of a large stored table for a set of keys, found by the files' own Bloom filters where the keys are few."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

# Up to so many keys are looked up; more of them are joined, which reads the key columns of all rows.
PROBED = 500
# Spark hands a list of up to ten values to Parquet value by value, a longer one only as a range.
_LISTED = 10


def with_bloom_filters(writer: DataFrameWriter, columns: Sequence[str]) -> DataFrameWriter:
    """``writer`` with a Bloom filter per row group on each column, sized by its distinct values."""
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


def is_one_of(column: str, values: Sequence) -> Column:
    """``column in values`` in lists that reach the files' filters value by value."""
    lists = [F.col(column).isin(*values[i : i + _LISTED]) for i in range(0, len(values), _LISTED)]
    while len(lists) > 1:
        lists = [reduce(Column.__or__, lists[i : i + 2]) for i in range(0, len(lists), 2)]
    return lists[0] if lists else F.lit(False)


def with_keys(rows: DataFrame, keys: DataFrame, key: Sequence[str], probed: int = PROBED) -> DataFrame:
    """The rows whose key ``keys`` has; keys with a null are in no row.

    Up to ``probed`` values of the first key column are looked up: of files written with
    :func:`with_bloom_filters` only the row groups that may hold one of them are read. Beyond that the two
    are joined. Both give the same rows. ``keys`` is run once to see which it is, so store what is dear.
    """
    first, key = key[0], list(key)
    known = keys.select(first).where(F.col(first).isNotNull()).distinct().limit(probed + 1).collect()
    if len(known) <= probed:
        rows = rows.where(is_one_of(first, sorted(r[0] for r in known)))
        if len(key) == 1:
            return rows
    return rows.join(keys.select(*key), key, "left_semi")
