"""Readers for the raw feeds: CSV exports, Parquet folders or catalog tables.

Each returns a dict from raw table name to a lazy DataFrame, which is what
``tidemart.plans.models.Models`` takes.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    NumericType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tidemart.functions.columns import month_start
from tidemart.operators.lookup import with_bloom_filters
from tidemart.session import scratch_path
from tidemart.sources.schemas import RAW_SCHEMAS, RAW_TABLE_GROUP

# Feeds joined or rolled up by order.
ORDER_KEYED = ("orders", "order_lines", "refunds")
# Partition column of feeds and tables stored by the month in which the order was created.
ORDER_MONTH = "order_month"


# Packs keys and texts of stored tables to about half of what Spark's own choice of codec leaves.
CODEC = "zstd"

# The column that holds the text of a line that does not fit its table.
_REJECTED = "_rejected"


def _csv(spark: SparkSession, path: str, schema: str, line_breaks: bool, **options) -> DataFrame:
    fixed = {"header": True, "enforceSchema": False, "escape": '"', "multiLine": line_breaks}
    return spark.read.schema(schema).options(**fixed, **options).csv(path)


def read_csv_feeds(
    spark: SparkSession,
    folder: str,
    tables: Iterable[str] = tuple(RAW_SCHEMAS),
    line_breaks: Collection[str] = (),
) -> dict[str, DataFrame]:
    """``folder/<table>.csv`` with a header; a bad value or a reordered header raises.

    Quotes within a quoted field are doubled. A large file is read in splits by many tasks. The
    tables named in ``line_breaks`` may hold line breaks within quoted fields; a file of theirs is one task.
    """
    return {
        table: _csv(spark, f"{folder}/{table}.csv", RAW_SCHEMAS[table], table in line_breaks, mode="FAILFAST")
        for table in tables
    }


def read_csv_leniently(
    spark: SparkSession, path: str, table: str, line_breaks: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The lines of a CSV that fit ``table``, and the others as ``file, line``: their text as it stands.

    A line with a value of another type, or with too few or too many fields, does not fit. No line is lost or ends
    the job. Lines are parsed once, in full, into the scratch folder, which both results read: a scan of some
    columns would not see that another one does not fit.
    """
    schema, names = f"{RAW_SCHEMAS[table]}, {_REJECTED} string", StructType.fromDDL(RAW_SCHEMAS[table]).names
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _REJECTED}
    lines = _csv(spark, path, schema, line_breaks, **options)
    landed = scratch_path(spark, f"csv-{table}")
    lines.select(*names, _REJECTED, F.col("_metadata.file_path").alias("_file")).write.parquet(landed)
    parsed = spark.read.parquet(landed)
    rejected = parsed.where(F.col(_REJECTED).isNotNull())
    fitting = parsed.where(F.col(_REJECTED).isNull()).select(*names)
    return fitting, rejected.select(F.col("_file").alias("file"), F.col(_REJECTED).alias("line"))


def write_csv_feeds(raw: dict[str, DataFrame], folder: str, tables: Iterable[str]) -> None:
    """Write feeds as ``read_csv_feeds`` reads them."""
    for table in tables:
        feed = raw[table].select(*StructType.fromDDL(RAW_SCHEMAS[table]).names)
        writer = feed.write.mode("overwrite").options(header=True, escape='"', emptyValue='""')
        writer.csv(f"{folder}/{table}.csv")


def _exactly(column: StructField, wanted: DataType) -> Column:
    """A column as another type; a number that would lose digits, or a time that would lose its hours, raises.

    A time with a zone for a column without one is refused: its value would follow the session's zone.
    """
    value = F.col(column.name)
    if column.dataType == wanted:
        return value
    if isinstance(column.dataType, TimestampType) and isinstance(wanted, TimestampNTZType):
        raise TypeError(f"{column.name} has times with a zone, declared without one: convert it first")
    cast = value.cast(wanted)
    numbers = isinstance(column.dataType, NumericType) and isinstance(wanted, NumericType)
    dated = isinstance(column.dataType, (TimestampType, TimestampNTZType)) and isinstance(wanted, DateType)
    if not (numbers or dated):
        return cast.alias(column.name)
    message = F.concat(F.lit(f"{column.name} does not fit {wanted.simpleString()}: "), value.cast("string"))
    return F.when(cast != value, F.raise_error(message)).otherwise(cast).alias(column.name)


def declared(frame: DataFrame, table: str) -> DataFrame:
    """A feed with its declared columns and types, then any others it has."""
    fields = {f.name: f.dataType for f in StructType.fromDDL(RAW_SCHEMAS[table])}
    others = [c for c in frame.columns if c not in fields]
    return frame.select(*[_exactly(frame.schema[name], kind) for name, kind in fields.items()], *others)


def read_parquet_feeds(
    spark: SparkSession, folder: str, tables: Iterable[str] = tuple(RAW_SCHEMAS)
) -> dict[str, DataFrame]:
    """``folder/<group>/<table>`` Parquet folders, as written by ``write_raw_tables``."""
    return {
        t: declared(spark.read.parquet(f"{folder}/{RAW_TABLE_GROUP[t]}/{t}"), t) for t in tables
    }


def read_catalog_feeds(
    spark: SparkSession, tables: Iterable[str] = tuple(RAW_SCHEMAS)
) -> dict[str, DataFrame]:
    """Catalog tables named ``<group>.<table>``."""
    return {t: declared(spark.table(f"{RAW_TABLE_GROUP[t]}.{t}"), t) for t in tables}


def write_raw_tables(raw: dict[str, DataFrame], folder: str) -> None:
    """Land the feeds as Parquet, one folder per source group."""
    for table, frame in raw.items():
        frame.write.mode("overwrite").parquet(f"{folder}/{RAW_TABLE_GROUP[table]}/{table}")


def write_catalog_feeds(spark: SparkSession, raw: dict[str, DataFrame], schema: str | None = None) -> None:
    """Land the feeds as catalog tables ``<group>.<table>``, or all in one schema."""
    for table, frame in raw.items():
        group = schema or RAW_TABLE_GROUP[table]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {group}")
        frame.write.mode("overwrite").option("compression", CODEC).saveAsTable(f"{group}.{table}")


def write_monthly_feeds(raw: dict[str, DataFrame], folder: str) -> None:
    """Land the feeds as ``write_raw_tables`` does, lines and refunds by the month of their order.

    Loads of the order fact then read the months they touch only, or by Bloom filters on the order id the row
    groups that may hold a changed order. Lines and refunds of an unknown order have no month.
    """
    months = raw["orders"].select("order_id", month_start(F.to_date("created_at")).alias(ORDER_MONTH))
    write_raw_tables({t: f for t, f in raw.items() if t not in ("order_lines", "refunds")}, folder)
    for table in ("order_lines", "refunds"):
        dated = raw[table].join(months, "order_id", "left").select(*raw[table].columns, ORDER_MONTH)
        balanced = dated.hint("rebalance", F.col(ORDER_MONTH))
        path = f"{folder}/{RAW_TABLE_GROUP[table]}/{table}"
        writer = with_bloom_filters(balanced.write, ["order_id"])
        writer.mode("overwrite").partitionBy(ORDER_MONTH).parquet(path)


def write_bucketed_feeds(
    spark: SparkSession, raw: dict[str, DataFrame], buckets: int, tables: Iterable[str] = ORDER_KEYED
) -> dict[str, DataFrame]:
    """Store the order-keyed feeds as catalog tables bucketed and sorted by ``order_id``.

    Roll-ups and joins on ``order_id`` then need no shuffle, which is worth one more write
    where the marts are rebuilt often. Rows are shuffled by bucket first, so each bucket is
    one file per writer.
    """
    stored = dict(raw)
    for table in tables:
        group = RAW_TABLE_GROUP[table]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {group}")
        name = f"{group}.{table}_by_order"
        raw[table].repartition(buckets, "order_id").write.mode("overwrite").bucketBy(
            buckets, "order_id"
        ).sortBy("order_id").saveAsTable(name)
        stored[table] = spark.table(name)
    return stored
