"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on ``keys`` where one side comes out of an aggregate on them.

    Adaptive execution splits a partition that one key makes large when both sides of a
    sort-merge join come straight from a shuffle for it. An aggregate on the keys is partitioned
    already and would be joined as it is, without a shuffle to split. So the sides are joined on a
    hash of the keys as well, which follows from them and changes no result: the aggregate, one
    row per key, is shuffled once more, and the other side's large partitions can be split.
    """
    keys = list(keys)
    hashed = [side.withColumn("key_hash", F.xxhash64(*keys)) for side in (left, right)]
    return hashed[0].join(hashed[1], [*keys, "key_hash"], how).drop("key_hash")
