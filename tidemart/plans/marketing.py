"""Marketing marts: campaign performance, attribution and blended return on spend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import (
    MONEY_SUM,
    cents,
    count_if,
    money,
    ratio_or_null,
    ratio_or_zero,
    sum_money,
    zero_if_null,
)
from tidemart.operators.skew import splittable_join
from tidemart.plans.intermediate import first_orders


def last_touch_revenue(economics: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue, orders and first-time buyers per (day, source, campaign).

    Economics are first grouped per customer within the cell, so distinct new customers
    become a plain count. Whether a day is the customer's first is looked up by customer and
    day: a customer with very many campaigns is not gathered in one task.
    """
    cell = ["order_date", "utm_source", "utm_campaign"]
    per_customer = economics.groupBy("customer_id", *cell).agg(
        F.sum(cents("net_subtotal_after_refunds")).alias("revenue_cents"),
        F.count(F.lit(1)).alias("orders"),
    )
    first_days = (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("order_date"))
        .withColumn("is_first_day", F.lit(True))
    )
    dated = per_customer.join(first_days, ["customer_id", "order_date"], "left")
    return dated.groupBy(*cell).agg(
        money(F.sum("revenue_cents")).alias("last_touch_revenue"),
        F.sum("orders").alias("last_touch_orders"),
        count_if(F.col("is_first_day")).alias("last_touch_new_customers"),
    )


def fct_marketing_performance(
    spend: DataFrame, campaigns: DataFrame, economics: DataFrame, orders: DataFrame
) -> DataFrame:
    """Spend per day and campaign beside platform-reported and last-touch revenue.

    Campaigns that share a ``utm_campaign`` each get that day's full last-touch revenue.
    """
    tags = campaigns.select("campaign_id", "utm_campaign")
    touched = last_touch_revenue(economics, orders).select(
        F.col("order_date").alias("date_day"),
        F.col("utm_source").alias("platform"),
        "utm_campaign",
        "last_touch_revenue",
        "last_touch_orders",
        "last_touch_new_customers",
    )
    joined = spend.join(tags, "campaign_id", "left").join(
        touched, ["date_day", "platform", "utm_campaign"], "left"
    )
    revenue = F.coalesce(F.col("last_touch_revenue"), F.lit(0)).cast(MONEY_SUM)
    new_customers = zero_if_null("last_touch_new_customers")
    return joined.select(
        "date_day",
        "platform",
        "campaign_id",
        "campaign_name",
        "utm_campaign",
        "impressions",
        "clicks",
        "spend",
        F.col("reported_conversions").alias("platform_reported_conversions"),
        F.col("reported_conversion_value").alias("platform_reported_revenue"),
        revenue.alias("last_touch_revenue"),
        zero_if_null("last_touch_orders").alias("last_touch_orders"),
        new_customers.alias("last_touch_new_customers"),
        ratio_or_zero("reported_conversion_value", "spend").alias("platform_reported_roas"),
        ratio_or_zero(revenue, "spend").alias("last_touch_roas"),
        F.when(F.col("spend") > 0, ratio_or_null("spend", new_customers)).alias("cac_last_touch"),
    )


def fct_attribution_first_touch(orders: DataFrame, economics: DataFrame) -> DataFrame:
    """Each member order with the UTM fields of that customer's first order.

    The first orders come out of an aggregate on ``customer_id``, hence the splittable join.
    """
    firsts = first_orders(orders.where(F.col("customer_id").isNotNull()))
    member_economics = economics.where(F.col("customer_id").isNotNull()).select(
        "order_id", "order_date", "customer_id", "net_subtotal_after_refunds", "contribution_margin"
    )
    joined = splittable_join(member_economics, firsts, ["customer_id"])
    return joined.select(
        "order_id",
        "order_date",
        "customer_id",
        "first_order_date",
        (F.col("order_date") == F.col("first_order_date")).alias("is_first_order"),
        F.col("acquisition_source").alias("first_touch_source"),
        F.col("acquisition_medium").alias("first_touch_medium"),
        F.col("acquisition_campaign").alias("first_touch_campaign"),
        F.col("net_subtotal_after_refunds").alias("attributed_revenue"),
        F.col("contribution_margin").alias("attributed_contribution_margin"),
    )


def fct_attribution_last_touch(economics: DataFrame) -> DataFrame:
    return economics.select(
        "order_id",
        "order_date",
        "customer_id",
        F.col("utm_source").alias("last_touch_source"),
        F.col("utm_medium").alias("last_touch_medium"),
        F.col("utm_campaign").alias("last_touch_campaign"),
        F.col("net_subtotal_after_refunds").alias("attributed_revenue"),
        F.col("contribution_margin").alias("attributed_contribution_margin"),
    )


def fct_blended_roas(
    calendar: DataFrame, economics: DataFrame, spend: DataFrame, start_date, end_date
) -> DataFrame:
    """All revenue over all paid spend per calendar day; days without either are kept.

    The calendar's own range is applied to orders and spend before they are shuffled.
    """
    in_range = F.col("date_day").between(F.lit(start_date), F.lit(end_date))
    daily_revenue = (
        economics.withColumnRenamed("order_date", "date_day")
        .where(in_range)
        .groupBy("date_day")
        .agg(
            sum_money("net_subtotal_after_refunds").alias("revenue"),
            sum_money("contribution_margin").alias("margin"),
            F.count("order_id").alias("orders"),
        )
    )
    daily_spend = (
        spend.where(in_range)
        .groupBy("date_day")
        .agg(
            sum_money("spend").alias("spend"),
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
        )
    )

    def amount(column: str):
        return F.coalesce(F.col(column), F.lit(0)).cast(MONEY_SUM)

    return (
        calendar.select("date_day")
        .where(in_range)
        .join(daily_revenue, "date_day", "left")
        .join(daily_spend, "date_day", "left")
        .select(
            "date_day",
            amount("spend").alias("total_spend"),
            zero_if_null("impressions").alias("total_impressions"),
            zero_if_null("clicks").alias("total_clicks"),
            amount("revenue").alias("total_revenue"),
            amount("margin").alias("total_contribution_margin"),
            zero_if_null("orders").alias("total_orders"),
            ratio_or_null(amount("revenue"), amount("spend")).alias("blended_roas"),
            ratio_or_null(amount("margin"), amount("spend")).alias("contribution_margin_mer"),
        )
    )
