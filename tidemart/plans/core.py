"""Core marts: dimensions, the order fact and the order-line fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import (
    MONEY,
    MONEY_SUM,
    month_start,
    ratio_or_zero,
    surrogate_key,
    zero_if_null,
)
from tidemart.plans.intermediate import line_costs, with_customer

FCT_ORDERS_COLUMNS = (
    "order_id", "order_number", "customer_id", "customer_email", "customer_country_code",
    "ordered_at", "processed_at", "order_date", "financial_status", "fulfillment_status",
    "has_refund", "currency", "order_subtotal", "order_tax", "order_discount", "order_shipping",
    "order_total", "refund_amount", "refund_count", "net_subtotal_after_refunds", "order_cogs",
    "line_count", "units_ordered", "contribution_margin", "contribution_margin_pct", "utm_source",
    "utm_medium", "utm_campaign", "source_name", "referring_site",
)


def dim_dates(days: DataFrame) -> DataFrame:
    day = F.col("date_day")
    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        # Sunday is 0.
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.trunc(day, "week").alias("week_start_date"),
        month_start(day).alias("month_start_date"),
        F.trunc(day, "quarter").alias("quarter_start_date"),
        F.trunc(day, "year").alias("year_start_date"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    others = [c for c in products.columns if c != "product_id"]
    return products.select("product_id", surrogate_key("product_id").alias("product_sk"), *others)


def dim_customers(customers: DataFrame, history: DataFrame, countries: DataFrame) -> DataFrame:
    regions = countries.select("country_code", "country_name", F.col("region").alias("country_region"))
    joined = customers.join(history, "customer_id", "left").join(regions, "country_code", "left")

    def total(column: str, output: str):
        return F.coalesce(F.col(column), F.lit(0)).cast(MONEY_SUM).alias(output)

    return joined.select(
        "customer_id",
        surrogate_key("customer_id").alias("customer_sk"),
        "email",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "phone",
        "country_code",
        "country_name",
        "country_region",
        "accepts_marketing",
        "customer_created_at",
        zero_if_null("lifetime_order_count").alias("lifetime_order_count"),
        total("lifetime_gross_subtotal", "lifetime_gross_revenue"),
        total("lifetime_net_subtotal", "lifetime_net_revenue"),
        total("lifetime_refund_amount", "lifetime_refund_amount"),
        F.coalesce("average_order_value", F.lit(0.0)).alias("average_order_value"),
        F.coalesce("is_repeat_customer", F.lit(False)).alias("is_repeat_customer"),
        zero_if_null("repeat_order_count").alias("repeat_order_count"),
        "first_ordered_at",
        "first_order_date",
        "acquisition_source",
        "acquisition_medium",
        "acquisition_campaign",
        "last_ordered_at",
        "last_order_date",
    )


def order_economics(net: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """Net orders with cost of goods and contribution margin, before customer attributes.

    Refunds, lines and orders are all shuffled on ``order_id``, so the joins share one
    partitioning.
    """
    revenue = F.col("net_subtotal_after_refunds")
    return (
        net.join(line_costs(lines, products), "order_id", "left")
        .withColumns(
            {
                "order_cogs": F.coalesce(F.col("order_cogs"), F.lit(0)).cast(MONEY),
                "line_count": zero_if_null("line_count"),
                "units_ordered": zero_if_null("units_ordered"),
            }
        )
        .withColumn("contribution_margin", (revenue - F.col("order_cogs")).cast(MONEY))
        .withColumn("contribution_margin_pct", ratio_or_zero("contribution_margin", revenue))
    )


def fct_orders(economics: DataFrame, customers: DataFrame) -> DataFrame:
    return with_customer(economics, customers).select(*FCT_ORDERS_COLUMNS)


def fct_order_items(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Lines that belong to a known order, with product cost and the order's attribution.

    Needs neither refunds nor customer attributes, so it reads staged orders.
    """
    order_part = orders.select(
        "order_id", "customer_id", "order_date", "utm_source", "utm_medium", "utm_campaign"
    )
    product_part = products.select("product_id", "product_cost", "product_title", "product_type")
    cost = F.coalesce(F.col("product_cost"), F.lit(0)).cast("decimal(12,2)")
    cogs = (F.col("quantity") * cost).cast(MONEY)
    return (
        lines.drop("product_title")
        .join(order_part, "order_id")
        .join(product_part, "product_id", "left")
        .select(
            "order_line_id",
            "order_id",
            "customer_id",
            "order_date",
            "product_id",
            "product_title",
            "product_type",
            "sku",
            "quantity",
            "unit_price",
            "line_discount",
            "gross_line_revenue",
            "net_line_revenue",
            cost.alias("unit_cost"),
            cogs.alias("line_cogs"),
            (F.col("net_line_revenue") - cogs).cast(MONEY).alias("line_gross_margin"),
            "utm_source",
            "utm_medium",
            "utm_campaign",
        )
    )
