"""Dashboard queries over the marts. Each takes marts and returns a small result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import (
    DIRECT_SOURCE,
    MONEY_SUM,
    count_if,
    mean,
    mean_money,
    mean_of_ratios,
    month_start,
    ratio_of_sums,
    sum_money,
)


def _unpivot(
    df: DataFrame, ids: list[str], labels: Mapping[str, str], variable: str, value: str
) -> DataFrame:
    """Long form of the columns in ``labels``, named by their label.

    The labels are fixed values: the dashboards' series names.
    """
    long = df.unpivot(ids, list(labels), variable, value)
    name: Column = F.col(variable)
    for column, label in labels.items():
        name = F.when(F.col(variable) == column, label).otherwise(name)
    return long.withColumn(variable, name)


# --- executive summary -----------------------------------------------------------------


def headline_kpis(fct_orders: DataFrame) -> DataFrame:
    gross, net = sum_money("order_subtotal"), sum_money("net_subtotal_after_refunds")
    margin = sum_money("contribution_margin")
    return fct_orders.agg(
        net.alias("net_revenue"),
        margin.alias("contribution_margin"),
        ratio_of_sums(margin, net).alias("cm_pct"),
        (gross - net).cast(MONEY_SUM).alias("refund_amount"),
        F.count("order_id").alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        mean_money("order_subtotal").alias("aov"),
    )


def total_spend(performance: DataFrame) -> DataFrame:
    return performance.agg(sum_money("spend").alias("total_spend"))


def blended_totals(blended: DataFrame) -> DataFrame:
    revenue, spend = sum_money("total_revenue"), sum_money("total_spend")
    return blended.agg(
        revenue.alias("total_revenue"),
        spend.alias("total_spend"),
        ratio_of_sums(revenue, spend).alias("blended_roas"),
        ratio_of_sums(sum_money("total_contribution_margin"), spend).alias("cm_mer"),
    )


def daily_revenue_spend(blended: DataFrame) -> DataFrame:
    return (
        blended.where("total_revenue > 0 or total_spend > 0")
        .select(
            "date_day", "total_revenue", "total_spend", "total_contribution_margin", "blended_roas"
        )
        .orderBy("date_day")
    )


def daily_long(blended: DataFrame) -> DataFrame:
    labels = {"total_revenue": "Revenue", "total_spend": "Paid spend"}
    return _unpivot(daily_revenue_spend(blended), ["date_day"], labels, "series", "dollars")


def channel_split(last_touch: DataFrame) -> DataFrame:
    return (
        last_touch.groupBy(
            F.coalesce("last_touch_source", F.lit(DIRECT_SOURCE)).alias("last_touch_source")
        )
        .agg(sum_money("attributed_revenue").alias("revenue"), F.count("order_id").alias("orders"))
        .orderBy(F.desc("revenue"))
    )


# --- marketing -------------------------------------------------------------------------


def marketing_totals(performance: DataFrame) -> DataFrame:
    spend = sum_money("spend")
    platform, last_touch = sum_money("platform_reported_revenue"), sum_money("last_touch_revenue")
    return performance.agg(
        spend.alias("total_spend"),
        platform.alias("platform_reported_revenue"),
        last_touch.alias("last_touch_revenue"),
        ratio_of_sums(platform, spend).alias("platform_reported_roas"),
        ratio_of_sums(last_touch, spend).alias("last_touch_roas"),
    )


def blended_single(blended: DataFrame) -> DataFrame:
    return blended.agg(
        ratio_of_sums(sum_money("total_revenue"), sum_money("total_spend")).alias("blended_roas")
    )


def daily_roas(blended: DataFrame) -> DataFrame:
    return (
        blended.where("total_spend > 0")
        .select(
            "date_day", "total_revenue", "total_spend", "blended_roas", "contribution_margin_mer"
        )
        .orderBy("date_day")
    )


def roas_long(blended: DataFrame) -> DataFrame:
    labels = {
        "blended_roas": "Blended ROAS",
        "contribution_margin_mer": "Contribution-margin MER",
    }
    return _unpivot(daily_roas(blended), ["date_day"], labels, "metric", "multiple")


def by_campaign(performance: DataFrame) -> DataFrame:
    spend, clicks = sum_money("spend"), F.sum("clicks")
    platform, last_touch = sum_money("platform_reported_revenue"), sum_money("last_touch_revenue")
    return (
        performance.groupBy("campaign_name")
        .agg(
            spend.alias("spend"),
            F.sum("impressions").alias("impressions"),
            clicks.alias("clicks"),
            ratio_of_sums(spend, clicks).alias("cpc"),
            platform.alias("platform_revenue"),
            last_touch.alias("last_touch_revenue"),
            ratio_of_sums(platform, spend).alias("platform_roas"),
            ratio_of_sums(last_touch, spend).alias("last_touch_roas"),
        )
        .orderBy(F.desc("spend"))
    )


def monthly_campaign_spend(performance: DataFrame) -> DataFrame:
    return (
        performance.groupBy(month_start("date_day").alias("month"), "campaign_name")
        .agg(sum_money("spend").alias("spend"))
        .orderBy("month", F.desc("spend"))
    )


# --- customers -------------------------------------------------------------------------


def customer_kpis(dim_customers: DataFrame) -> DataFrame:
    customers, repeaters = F.count(F.lit(1)), count_if(F.col("is_repeat_customer"))
    return dim_customers.agg(
        customers.alias("customers"),
        repeaters.alias("repeat_customers"),
        ratio_of_sums(repeaters, customers).alias("repeat_rate"),
        mean_of_ratios("average_order_value").alias("avg_aov"),
        mean_money("lifetime_net_revenue").alias("avg_ltv"),
    )


def cohort_grid(retention: DataFrame) -> DataFrame:
    return retention.orderBy("cohort_month", "months_since_acquisition").select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort"),
        F.col("months_since_acquisition").alias("month_n"),
        "cohort_customers",
        "active_customers",
        "retention_rate",
    )


def ltv_by_channel(dim_customers: DataFrame, ltv: DataFrame) -> DataFrame:
    return (
        dim_customers.select("customer_id", "acquisition_source")
        .join(ltv.select("customer_id", "ltv_revenue_total", "ltv_margin_total"), "customer_id")
        .groupBy(F.coalesce("acquisition_source", F.lit("(unknown)")).alias("acquisition_source"))
        .agg(
            F.count("customer_id").alias("customers"),
            mean_money("ltv_revenue_total").alias("avg_ltv"),
            mean_money("ltv_margin_total").alias("avg_margin_ltv"),
        )
        .orderBy(F.desc("avg_ltv"))
    )


def ltv_long(dim_customers: DataFrame, ltv: DataFrame) -> DataFrame:
    labels = {"avg_ltv": "Avg LTV (revenue)", "avg_margin_ltv": "Avg LTV (margin)"}
    return _unpivot(
        ltv_by_channel(dim_customers, ltv),
        ["acquisition_source", "customers"],
        labels,
        "metric",
        "dollars",
    )


def rfm_segments(rfm: DataFrame) -> DataFrame:
    return (
        rfm.groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            mean_money("monetary").alias("avg_monetary"),
            mean("recency_days").alias("avg_recency_days"),
        )
        .orderBy(F.desc("customers"))
    )


# --- orders and products ---------------------------------------------------------------


def order_kpis(fct_orders: DataFrame) -> DataFrame:
    net = sum_money("net_subtotal_after_refunds")
    return fct_orders.agg(
        F.count("order_id").alias("orders"),
        net.alias("net_revenue"),
        mean_money("order_subtotal").alias("aov"),
        ratio_of_sums(sum_money("refund_amount"), sum_money("order_subtotal")).alias("refund_rate"),
        ratio_of_sums(sum_money("contribution_margin"), net).alias("cm_pct"),
    )


def daily_orders(fct_orders: DataFrame) -> DataFrame:
    return (
        fct_orders.groupBy("order_date")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            sum_money("net_subtotal_after_refunds").alias("net_revenue"),
            mean_money("order_subtotal").alias("aov"),
        )
        .orderBy("order_date")
    )


def product_revenue(order_items: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Lines are summed per product before the product lookup, so no line is shuffled raw."""
    per_product = order_items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"),
        sum_money("net_line_revenue").alias("revenue"),
        sum_money("line_gross_margin").alias("margin"),
    )
    titles = dim_products.select("product_id", "product_title", "product_type")
    revenue, margin = sum_money("revenue"), sum_money("margin")
    return (
        per_product.join(titles, "product_id")
        .groupBy("product_title", "product_type")
        .agg(
            F.sum("units").alias("units_sold"),
            revenue.alias("net_revenue"),
            margin.alias("gross_margin"),
            ratio_of_sums(margin, revenue).alias("margin_pct"),
        )
        .orderBy(F.desc("net_revenue"))
    )


def product_margin(order_items: DataFrame) -> DataFrame:
    revenue, margin = sum_money("net_line_revenue"), sum_money("line_gross_margin")
    return (
        order_items.groupBy("product_title")
        .agg(
            revenue.alias("net_revenue"),
            margin.alias("gross_margin"),
            ratio_of_sums(margin, revenue).alias("margin_pct"),
        )
        .orderBy(F.desc("gross_margin"))
    )


def margin_long(order_items: DataFrame) -> DataFrame:
    labels = {"net_revenue": "Net revenue", "gross_margin": "Gross margin"}
    return _unpivot(
        product_margin(order_items), ["product_title", "margin_pct"], labels, "metric", "dollars"
    )
