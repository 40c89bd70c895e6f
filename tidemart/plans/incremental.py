"""Incremental load of the order fact."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import month_start
from tidemart.operators.lookup import with_keys
from tidemart.operators.upsert import newest_value, partitions_of, read_table, upsert_table
from tidemart.plans import core, intermediate, staging
from tidemart.plans.models import Models
from tidemart.session import scratch_table
from tidemart.sources.raw import ORDER_MONTH

# Fixed value: the high-watermark of an empty table.
BEGINNING = datetime(1900, 1, 1)


def with_order_month(orders: DataFrame) -> DataFrame:
    """Add the partition column."""
    return orders.withColumn(ORDER_MONTH, month_start("order_date"))


def high_watermark(models: Models, table: str) -> datetime:
    """The newest processing time ever loaded, which the table keeps; no scan."""
    newest = newest_value(models.spark, table)
    return datetime.fromisoformat(newest) if newest else BEGINNING


def orders_since(models: Models, watermark: datetime, with_refunded: bool = False) -> DataFrame:
    """Staged orders processed at or after ``watermark``.

    The feed is expected to advance ``processed_at`` when an order is refunded. Where it
    does not, ``with_refunded`` also takes orders that received a refund since then.
    """
    since = F.lit(watermark.isoformat(sep=" ")).cast("timestamp_ntz")
    orders = models["stg_orders"]
    recent = F.col("processed_at") >= since
    if not with_refunded:
        return orders.where(recent)
    refunded = (
        models["stg_refunds"]
        .where(F.col("refunded_at") >= since)
        .select("order_id", F.lit(True).alias("refunded"))
        .distinct()
    )
    marked = orders.join(refunded, "order_id", "left")
    return marked.where(recent | F.col("refunded")).drop("refunded")


def orders_beyond(orders: DataFrame, fact: DataFrame) -> DataFrame:
    """Staged orders processed at or after the newest order of ``fact``, as one plan.

    For facts without a kept watermark, such as a mart in a folder or the catalog: the newest time is
    a scalar subquery, which the scan of the orders takes as a filter when it starts. Of an empty fact, all orders.
    """
    beginning = F.lit(BEGINNING.isoformat(sep=" ")).cast("timestamp_ntz")
    newest = fact.agg(F.coalesce(F.max("processed_at"), beginning).alias("newest"))
    return orders.where(F.col("processed_at") >= newest.scalar())


# Feeds that ``write_monthly_feeds`` may have stored by order month, and their staging.
_BY_MONTH = {"order_lines": staging.order_lines, "refunds": staging.refunds}


def _is_monthly(models: Models, table: str) -> bool:
    return f"stg_{table}" not in models.stored and ORDER_MONTH in models.raw[table].columns


def _staged(models: Models, table: str, months: list[date | None]) -> DataFrame:
    """A staged feed, cut to some order months where the raw feed is stored by them.

    What landed before its order has no month, so that partition is always read.
    """
    if not _is_monthly(models, table):
        return models[f"stg_{table}"]
    month = F.col(ORDER_MONTH)
    wanted = month.isin([m for m in months if m is not None])
    return _BY_MONTH[table](models.raw[table].where(wanted | month.isNull()))


def order_rows(models: Models, orders: DataFrame, dates_change: bool = False) -> DataFrame:
    """Order-fact rows for some staged orders; only their lines and refunds are shuffled.

    The lines and refunds of few orders are looked up by order id: where the feeds were written with Bloom filters
    (``write_monthly_feeds``), only the row groups that may hold one of the orders are read. Where they are
    stored by order month and dates never change, only the months of these orders, and what has none,
    are read at all; with ``dates_change`` lines may have landed under an earlier date.
    """
    ids = orders.select("order_id")
    if not dates_change and any(_is_monthly(models, table) for table in _BY_MONTH):
        months = list(partitions_of(with_order_month(orders), ORDER_MONTH))
        lines, refunds = (_staged(models, table, months) for table in _BY_MONTH)
    else:
        lines, refunds = (models[f"stg_{table}"] for table in _BY_MONTH)
    economics = core.order_economics(
        intermediate.order_net(orders, with_keys(refunds, ids, ["order_id"])),
        with_keys(lines, ids, ["order_id"]),
        models["stg_products"],
    )
    return core.fct_orders(economics, models["stg_customers"])


def refresh_orders(
    models: Models, table: str, with_refunded: bool = False, rows_move: bool = True
) -> None:
    """Bring the order fact, the catalog table ``table``, up to date with the feeds.

    The first load takes all orders as one plan. Later ones store the changed orders and read what belongs to them. An
    order whose creation date was corrected moves to another month; its old row is looked up by id, which reads
    no month that holds none of the changed orders. Where no feed corrects dates, ``rows_move`` False saves
    the lookup; an order that had no date is found all the same.
    """
    changed = orders_since(models, high_watermark(models, table), with_refunded)
    options = {"rows_move": rows_move, "watermark": "processed_at"}
    if read_table(models.spark, table) is None:
        rows = core.fct_orders(
            core.order_economics(
                intermediate.order_net(changed, models["stg_refunds"]), models["stg_order_lines"], models["stg_products"]
            ),
            models["stg_customers"],
        )
        upsert_table(with_order_month(rows), table, ["order_id"], ORDER_MONTH, **options)
        return
    with scratch_table(changed, "changed_orders") as few:
        rows = order_rows(models, few, rows_move)
        upsert_table(with_order_month(rows), table, ["order_id"], ORDER_MONTH, **options)


def stored_orders(models: Models, table: str) -> DataFrame:
    """The order fact as stored, without its partition column."""
    stored = read_table(models.spark, table)
    if stored is None:
        raise ValueError(f"no load was ever committed to {table}")
    return stored.drop(ORDER_MONTH)
