"""Build the marts once and store them, so that reports scan small tables.

The order fact, the customer history and daily spend feed the other marts: they are written
first, and everything after reads them back.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tidemart.functions.columns import month_start
from tidemart.operators.upsert import balanced
from tidemart.plans.documentation import TABLE_COMMENTS, documented
from tidemart.plans.models import MARTS, STAGING, Models
from tidemart.plans.observation import Observed
from tidemart.session import planned_by_rows
from tidemart.sources.raw import CODEC, ORDER_MONTH

# Schemas are used verbatim as folder or database names.
SCHEMA_OF: dict[str, str] = {
    "int_customer_order_history": "intermediate",
    "int_unified_spend": "intermediate",
    "fct_orders": "marts_core",
    "fct_order_items": "marts_core",
    "dim_customers": "marts_core",
    "dim_products": "marts_core",
    "dim_dates": "marts_core",
    "fct_marketing_performance": "marts_marketing",
    "fct_attribution_first_touch": "marts_marketing",
    "fct_attribution_last_touch": "marts_marketing",
    "fct_blended_roas": "marts_marketing",
    "customer_ltv": "marts_customer",
    "customer_cohort_retention": "marts_customer",
    "customer_rfm": "marts_customer",
}

SCHEMA_OF |= dict.fromkeys(STAGING, "staging")
SCHEMA_OF |= dict.fromkeys(("int_orders_joined", "int_sessions_attributed"), "intermediate")

# Written one after the other, each may read those before it.
SHARED = ("fct_orders", "int_customer_order_history", "int_unified_spend")
# Written side by side: they read the shared tables and the feeds only.
INDEPENDENT = tuple(name for name in MARTS if name not in SHARED)
# What checks cover besides.
CHECKED = (*INDEPENDENT, "int_orders_joined", "int_sessions_attributed")
# Small marts leave cores idle, so a few are built at a time.
THREADS = 4

# Order- and line-grain tables are partitioned by month, so date filters skip files and the
# incremental load rewrites few of them.
MONTHLY = frozenset(
    {"fct_orders", "fct_order_items", "fct_attribution_first_touch", "fct_attribution_last_touch"}
)
# The tables dashboards read.
BI_TABLES = tuple(name for name in MARTS if name != "dim_dates")


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{SCHEMA_OF[name]}/{name}"


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    stored = spark.read.parquet(table_path(root, name))
    return stored.drop(ORDER_MONTH) if name in MONTHLY else stored


def read_marts(
    spark: SparkSession, root: str, names: Iterable[str] = BI_TABLES
) -> dict[str, DataFrame]:
    return {name: read_mart(spark, root, name) for name in names}


def _build(
    models: Models,
    store: Callable[[str, DataFrame], DataFrame],
    threads: int,
    names: Iterable[str] = INDEPENDENT,
) -> Models:
    """Store the shared marts and then ``names`` with ``store``, which writes and returns one table."""

    def reading(stored: dict[str, DataFrame]) -> Models:
        return Models(models.spark, models.raw, models.settings, stored, models.extra_spend)

    shared = dict(models.stored)
    for name in SHARED:
        shared[name] = store(name, documented(reading(shared)[name]))
    names = list(names)
    with ThreadPoolExecutor(threads) as pool:
        built = pool.map(lambda name: store(name, documented(reading(shared)[name])), names)
        return reading({**shared, **dict(zip(names, built, strict=True))})


def _monthly(rows: DataFrame) -> DataFrame:
    return rows.withColumn(ORDER_MONTH, month_start("order_date"))


def _staged(
    models: Models, store: Callable[[str, DataFrame], DataFrame], observed: Observed | None = None
) -> Models:
    """Store the staging layer with ``store``; each feed is watched by the write of what is staged from it.

    With ``observed``, only the tables with rules of their own or of their feed are stored.
    """
    stored = dict(models.stored)
    for name in STAGING:
        feed, raw = name.removeprefix("stg_"), models.raw
        if observed and not observed.watches(name) and not observed.watches(f"raw_{feed}"):
            continue
        if observed and feed in raw:
            raw = ChainMap({feed: observed.watching(f"raw_{feed}", raw[feed])}, raw)
        staged = Models(models.spark, raw, models.settings, stored, models.extra_spend)
        stored[name] = store(name, documented(staged[name]))
    return Models(models.spark, models.raw, models.settings, stored, models.extra_spend)


def build(
    models: Models,
    root: str,
    threads: int = THREADS,
    names: Iterable[str] = INDEPENDENT,
    observed: Observed | None = None,
) -> Models:
    """Write every mart as Parquet below ``root``; returns models that read the stored copies.

    ``names`` are the tables to write besides the shared ones, if not all marts. With ``observed`` what it
    watches of the staging layer is written first, and all writes count the rows that break their table's rules.
    """

    def store(name: str, rows: DataFrame) -> DataFrame:
        path = table_path(root, name)
        if name in MONTHLY:
            rows = balanced(_monthly(rows), ORDER_MONTH)
        if observed:
            rows = observed.watching(name, rows)
        writer = rows.write.mode("overwrite").option("compression", CODEC)
        (writer.partitionBy(ORDER_MONTH) if name in MONTHLY else writer).parquet(path)
        # An empty table by month has no file that a schema could be taken from.
        return models.spark.read.schema(rows.schema).parquet(path).drop(ORDER_MONTH)

    if not observed:
        return _build(models, store, threads, names)
    staged = _staged(models, store, observed)
    raw = ChainMap({"countries": observed.watching("raw_countries", models.raw["countries"])}, models.raw)
    watched = Models(staged.spark, raw, staged.settings, staged.stored, staged.extra_spend)
    built = _build(watched, store, threads, names)
    return Models(built.spark, models.raw, built.settings, built.stored, built.extra_spend)


def build_catalog(
    models: Models,
    location: str | None = None,
    threads: int = THREADS,
    staging: bool = False,
    names: Iterable[str] = INDEPENDENT,
) -> Models:
    """Like ``build``, into catalog tables ``<schema>.<name>`` with table and column comments.

    With ``staging`` the staging layer is stored as well, in a schema of its own; it is written first
    and everything else reads it. ``names`` are the tables to store besides the shared ones, if not all marts.

    The rows of the tables that others read are counted, from the ends of their files, and the plans go by these
    counts: what is broadcast is small by its rows, not only by its files.
    """
    spark = models.spark
    for schema in dict.fromkeys(SCHEMA_OF.values()):
        where = f" LOCATION '{location.rstrip('/')}/{schema}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}{where}")

    def store(name: str, rows: DataFrame) -> DataFrame:
        table = f"{SCHEMA_OF[name]}.{name}"
        if name in MONTHLY:
            writer = balanced(_monthly(rows), ORDER_MONTH).write.partitionBy(ORDER_MONTH)
        else:
            writer = rows.write
        writer.mode("overwrite").format("parquet").option("compression", CODEC).saveAsTable(table)
        if name in STAGING or name in SHARED:
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
        if name in TABLE_COMMENTS:
            comment = TABLE_COMMENTS[name].replace("'", "\\'")
            spark.sql(f"COMMENT ON TABLE {table} IS '{comment}'")
        return spark.table(table).drop(ORDER_MONTH)

    with planned_by_rows(spark):
        return _build(_staged(models, store) if staging else models, store, threads, names)


def create_staging_views(models: Models) -> None:
    """Expose the staging layer as temporary views, with comments and personal-data tags.

    They hold plans, not rows, and end with the session; ``build_catalog`` can store the layer.
    """
    for name in STAGING:
        documented(models[name]).createOrReplaceTempView(name)


def cache_reports(reports: dict[str, DataFrame], root: str) -> None:
    """Keep report results as Parquet for a dashboard to serve."""
    for name, result in reports.items():
        result.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


def read_cached_report(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A report as ``cache_reports`` keeps it."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")
