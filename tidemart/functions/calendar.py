"""Calendar generator."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def days_spanned(rows: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last date of a column; none if there is no date."""
    span = rows.agg(F.min(column).alias("low"), F.max(column).alias("high")).where("low is not null")
    return span.select(F.explode(F.sequence("low", "high")).alias("date_day"))


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` up to but not including ``end``."""
    days = spark.range(1).where(F.lit(start < end))
    last = max(end - timedelta(days=1), start)
    return days.select(F.explode(F.sequence(F.lit(start), F.lit(last))).alias("date_day"))
