"""The order fact kept current from a stream of order changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.upsert import latest_per_key, upsert_table
from tidemart.plans import staging
from tidemart.plans.incremental import ORDER_MONTH, order_rows, with_order_month
from tidemart.plans.models import Models
from tidemart.session import scratch_table


def apply_order_changes(
    models: Models, raw_orders: DataFrame, table: str, dates_change: bool = True
) -> None:
    """Upsert one batch of raw order changes; several changes of an order keep the newest.

    Replaying a batch writes the same rows again, and a batch that arrives late does not
    replace a row processed after it. The orders' old rows, lines and refunds are looked up by
    order id; with ``dates_change`` False, for a feed that never changes the creation date of an order
    once it has one, only the months of the batch and the orders without a date are searched.
    """
    newest = latest_per_key(staging.orders(raw_orders), ["order_id"], "processed_at")
    with scratch_table(newest, "batch") as batch:
        upsert_table(
            with_order_month(order_rows(models, batch, dates_change)),
            table,
            ["order_id"],
            ORDER_MONTH,
            version="processed_at",
            rows_move=dates_change,
            watermark="processed_at",
        )


def order_stream(
    models: Models,
    raw_orders: DataFrame,
    table: str,
    checkpoint: str,
    dates_change: bool = True,
) -> StreamingQuery:
    """Start applying a streaming feed of raw order rows to the order fact, the catalog table ``table``.

    Lines, refunds, products and customers are read from ``models`` as of each batch. The
    query takes what is available and stops; run it again, or schedule it, for the next.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        if not batch.isEmpty():
            apply_order_changes(models, batch, table, dates_change)

    return (
        raw_orders.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
