"""Shared roll-ups between staging and the marts.

``order_net`` and ``order_economics`` hold everything an order needs except customer
attributes. Marts that never show those attributes build on them directly, which saves the
shuffle on ``customer_id`` that the customer lookup costs. This relies on ``customer_id``
being unique in the customer feed, which the contract checks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.columns import (
    count_if,
    MONEY,
    MONEY_SUM,
    cents,
    earliest,
    mean_money,
    money,
    sum_money,
    zero_if_null,
)
from tidemart.operators.skew import splittable_join
from tidemart.plans.staging import ADS_PLATFORM, FUNNEL_EVENTS, SESSION_KEY, merchandise_value

ORDERS_JOINED_COLUMNS = (
    "order_id", "order_number", "customer_id", "customer_email", "customer_country_code",
    "ordered_at", "processed_at", "order_date", "financial_status", "fulfillment_status",
    "has_refund", "currency", "order_subtotal", "order_tax", "order_discount", "order_shipping",
    "order_total", "net_merchandise_value", "refund_amount", "refund_count",
    "net_subtotal_after_refunds", "utm_source", "utm_medium", "utm_campaign", "source_name",
    "referring_site",
)


def order_net(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """Orders with refunds rolled up first, so several refunds never multiply an order."""
    rolled = refunds.groupBy("order_id").agg(
        sum_money("refund_amount").cast(MONEY).alias("refunded"),
        F.count(F.lit(1)).alias("refunds"),
    )
    refunded = F.coalesce(F.col("refunded"), F.lit(0)).cast(MONEY)
    return (
        orders.join(rolled, "order_id", "left")
        .withColumns(
            {
                "refund_amount": refunded,
                "refund_count": zero_if_null("refunds"),
                "net_subtotal_after_refunds": (F.col("order_subtotal") - refunded).cast(MONEY),
            }
        )
        .drop("refunded", "refunds")
    )


def with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    lookup = customers.select(
        "customer_id",
        F.col("email").alias("customer_email"),
        F.col("country_code").alias("customer_country_code"),
    )
    return orders.join(lookup, "customer_id", "left")


def orders_joined(orders: DataFrame) -> DataFrame:
    """Net orders with customer attributes; those of the stored order fact lack the merchandise value."""
    if "net_merchandise_value" not in orders.columns:
        orders = orders.withColumn("net_merchandise_value", merchandise_value("order_subtotal", "order_discount"))
    return orders.select(*ORDERS_JOINED_COLUMNS)


def line_costs(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Cost of goods, line count and units per order; an unknown cost counts as zero."""
    costs = products.select("product_id", cents("product_cost").alias("unit_cents"))
    line_cents = F.col("quantity") * F.coalesce(F.col("unit_cents"), F.lit(0))
    return (
        lines.select("order_id", "product_id", "quantity")
        .join(costs, "product_id", "left")
        .groupBy("order_id")
        .agg(
            money(F.sum(line_cents)).cast(MONEY).alias("order_cogs"),
            F.count(F.lit(1)).alias("line_count"),
            F.sum("quantity").alias("units_ordered"),
        )
    )


def first_orders(orders: DataFrame) -> DataFrame:
    """Per customer the first order date and the first order's UTM fields.

    Ties go to the lower order id; orders without a time come last.
    """
    members = orders.where(F.col("customer_id").isNotNull())
    first = F.min_by(
        F.struct("utm_source", "utm_medium", "utm_campaign"), earliest("ordered_at", "order_id")
    )
    return (
        members.groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order_date"),
            first.alias("first"),
        )
        .select(
            "customer_id",
            "first_order_date",
            F.col("first.utm_source").alias("acquisition_source"),
            F.col("first.utm_medium").alias("acquisition_medium"),
            F.col("first.utm_campaign").alias("acquisition_campaign"),
        )
    )


def customer_order_history(net: DataFrame) -> DataFrame:
    """Lifetime totals per customer in one grouped pass; guest orders are left out."""
    members = net.where(F.col("customer_id").isNotNull())
    first = F.min_by(
        F.struct("utm_source", "utm_medium", "utm_campaign"), earliest("ordered_at", "order_id")
    )
    grouped = members.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lifetime_order_count"),
        sum_money("order_subtotal").alias("lifetime_gross_subtotal"),
        sum_money("net_subtotal_after_refunds").alias("lifetime_net_subtotal"),
        sum_money("order_total").alias("lifetime_order_total"),
        sum_money("refund_amount").alias("lifetime_refund_amount"),
        mean_money("order_subtotal").alias("average_order_value"),
        F.min("ordered_at").alias("first_ordered_at"),
        F.min("order_date").alias("first_order_date"),
        first.alias("first"),
        F.max("ordered_at").alias("last_ordered_at"),
        F.max("order_date").alias("last_order_date"),
    )
    return grouped.select(
        "customer_id",
        "lifetime_order_count",
        "lifetime_gross_subtotal",
        "lifetime_net_subtotal",
        "lifetime_order_total",
        "lifetime_refund_amount",
        "average_order_value",
        # Exactly one order of a customer is the first one.
        (F.col("lifetime_order_count") - 1).alias("repeat_order_count"),
        (F.col("lifetime_order_count") > 1).alias("is_repeat_customer"),
        "first_ordered_at",
        "first_order_date",
        F.col("first.utm_source").alias("acquisition_source"),
        F.col("first.utm_medium").alias("acquisition_medium"),
        F.col("first.utm_campaign").alias("acquisition_campaign"),
        "last_ordered_at",
        "last_order_date",
    )


def with_first_value(
    rows: DataFrame, period: str, output: str, has_guests: bool = False
) -> DataFrame:
    """Add each customer's earliest ``period`` to rows already grouped by customer and period.

    The caller groups first, so a customer contributes one row per period (and further
    grouping column) however many orders they placed. Guests have no first period; where
    they are present, a second partitioning column deals them out over many tasks.
    """
    if not has_guests:
        window = Window.partitionBy("customer_id")
        return rows.withColumn(output, F.min(period).over(window))
    guest = F.col("customer_id").isNull()
    window = Window.partitionBy("customer_id", F.when(guest, F.col(period)))
    return rows.withColumn(output, F.when(~guest, F.min(period).over(window)))


SPEND_MEASURES = ("impressions", "clicks", "spend", "reported_conversions", "reported_conversion_value")


def _spend_total(measure: str) -> Column:
    is_money = measure in ("spend", "reported_conversion_value")
    return (sum_money(measure) if is_money else F.sum(measure)).alias(measure)


def unioned_spend(platforms: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Daily spend of every platform at (day, platform, campaign) grain.

    Add a platform by adding its (insights, label) pair. Labels are grouping keys, so one
    grouped aggregate over the union equals one per platform.
    """
    labelled = [
        insights.select("date_day", F.lit(label).alias("platform"), "campaign_id", *SPEND_MEASURES)
        for insights, label in platforms
    ]
    rows = reduce(DataFrame.unionByName, labelled)
    return rows.groupBy("date_day", "platform", "campaign_id").agg(
        *[_spend_total(m) for m in SPEND_MEASURES]
    )


def unified_spend(platforms: Sequence[tuple[DataFrame, str]], campaigns: DataFrame) -> DataFrame:
    names = campaigns.select("campaign_id", "campaign_name", F.lit(ADS_PLATFORM).alias("platform"))
    return unioned_spend(platforms).join(names, ["campaign_id", "platform"], "left").select(
        "date_day",
        "platform",
        "campaign_id",
        F.coalesce("campaign_name", "campaign_id").alias("campaign_name"),
        *SPEND_MEASURES,
    )


def sessions_attributed(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """Sessions with the orders they may have led to, one row per session.

    A purchase session is linked to the orders of the same day, source, medium and campaign: how
    many there are, their subtotal, and the first of them by time and id. Listing every pair would
    give sessions times orders rows per day and channel, so orders are reduced to one row per
    day and channel before the join. Sessions without a purchase skip the join altogether.
    """
    kept = (
        *SESSION_KEY, "session_started_at", "session_date", "session_number", "session_source",
        "session_medium", "session_campaign", *[f"had_{n}" for n in FUNNEL_EVENTS],
        "page_view_count", "purchase_value",
    )
    match_on = ["session_date", "session_source", "session_medium", "session_campaign"]
    first = F.min_by(F.struct("order_id", "customer_id"), earliest("ordered_at", "order_id"))
    candidates = (
        orders.groupBy("order_date", "utm_source", "utm_medium", "utm_campaign")
        .agg(
            F.count(F.lit(1)).alias("linked_orders"),
            sum_money("order_subtotal").alias("linked_subtotal"),
            first.alias("first"),
        )
        .toDF(*match_on, "linked_orders", "linked_subtotal", "first")
    )
    buyers = sessions.where("had_purchase = 1").select(*kept).join(candidates, match_on, "left")
    others = sessions.where("had_purchase = 0").select(*kept)
    return buyers.select(
        *kept,
        F.col("first.order_id").alias("order_id"),
        F.col("first.customer_id").alias("customer_id"),
        "linked_orders",
        "linked_subtotal",
    ).unionByName(others, allowMissingColumns=True).withColumns(
        {
            "linked_orders": zero_if_null("linked_orders"),
            "linked_subtotal": F.coalesce("linked_subtotal", F.lit(0)).cast(MONEY_SUM),
        }
    )


# Where a session and an order meet.
LINK_CELL = ("session_date", "session_source", "session_medium", "session_campaign")


def link_members(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """Every link of a purchase session to an order of its day and channel, in factored form.

    All sessions of a cell are linked to all its orders, so the links are said by who is in the
    cell: one row per session and one per order, told apart by ``order_id``, instead of one per pair. Cells without a
    session or without an order have no row. :func:`links` multiplies out what is asked for.
    """
    buyers = sessions.where("had_purchase = 1").select(*LINK_CELL, *SESSION_KEY)
    bought = orders.select("order_date", "utm_source", "utm_medium", "utm_campaign", "order_id", "customer_id")
    bought = bought.toDF(*LINK_CELL, "order_id", "customer_id").where(F.col("order_id").isNotNull())
    members = buyers.unionByName(bought, allowMissingColumns=True).dropna("any", subset=list(LINK_CELL))
    counted = members.groupBy(*LINK_CELL).agg(
        count_if(F.col("order_id").isNull()).alias("sessions"), count_if(F.col("order_id").isNotNull()).alias("orders")
    )
    both = counted.where("sessions > 0 and orders > 0").select(*LINK_CELL)
    return splittable_join(members, both, LINK_CELL)


def link_counts(members: DataFrame) -> DataFrame:
    """Per cell its sessions, its orders and the links between them."""
    counted = members.groupBy(*LINK_CELL).agg(
        count_if(F.col("order_id").isNull()).alias("sessions"), count_if(F.col("order_id").isNotNull()).alias("orders")
    )
    return counted.withColumn("links", F.col("sessions") * F.col("orders"))


def links(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """The session-order pairs of some cells or members: ``wanted`` has any of the member columns.

    Give a few sessions, orders, days or campaigns; all pairs together grow with sessions times orders.
    """
    sessions = members.where(F.col("order_id").isNull()).drop("order_id", "customer_id")
    orders = members.where(F.col("order_id").isNotNull()).drop(*SESSION_KEY)
    keys = [c for c in wanted.columns if c in (*LINK_CELL, *SESSION_KEY, "order_id", "customer_id")]
    of_session = [c for c in keys if c in (*LINK_CELL, *SESSION_KEY)]
    of_order = [c for c in keys if c not in of_session]
    if of_session:
        sessions = sessions.join(wanted.select(*of_session).distinct(), of_session, "left_semi")
    if of_order:
        orders = orders.join(wanted.select(*of_order).distinct(), of_order, "left_semi")
    return sessions.join(orders, list(LINK_CELL))
