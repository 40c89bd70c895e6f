"""Customer marts: lifetime value, cohort retention and RFM segments.

Each groups orders per customer and day (or month) before anything is partitioned by
customer alone, so the busiest customer brings one row per day to its task, not one per
order.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.columns import (
    cents,
    days_between,
    money,
    month_start,
    month_starts_between,
    ratio_or_null,
)
from tidemart.operators.quantiles import ntile_scores
from tidemart.plans.intermediate import with_first_value

# The day windows reported, bounds inclusive.
REVENUE_WINDOWS = (30, 60, 90, 180, 365)
MARGIN_WINDOWS = (90, 365)


def customer_ltv(economics: DataFrame) -> DataFrame:
    per_day = (
        economics.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "order_date")
        .agg(
            F.sum(cents("net_subtotal_after_refunds")).alias("revenue"),
            F.sum(cents("contribution_margin")).alias("margin"),
        )
    )
    dated = with_first_value(per_day, "order_date", "first_order_date").withColumn(
        "age", days_between("first_order_date", "order_date")
    )

    def within(measure: str, days: int) -> Column:
        inside = F.when(F.col("age") <= days, F.col(measure)).otherwise(0)
        return money(F.sum(inside)).alias(f"ltv_{measure}_{days}d")

    return dated.groupBy("customer_id", "first_order_date").agg(
        money(F.sum("revenue")).alias("ltv_revenue_total"),
        money(F.sum("margin")).alias("ltv_margin_total"),
        *[within("revenue", days) for days in REVENUE_WINDOWS],
        *[within("margin", days) for days in MARGIN_WINDOWS],
    )


def customer_months(economics: DataFrame) -> DataFrame:
    """One row per customer and active month, with the cohort month. Amounts are in cents."""
    per_month = (
        economics.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", month_start("order_date").alias("activity_month"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(cents("net_subtotal_after_refunds")).alias("revenue"),
            F.sum(cents("contribution_margin")).alias("margin"),
        )
    )
    return with_first_value(per_month, "activity_month", "cohort_month")


def cohort_months(months: DataFrame) -> DataFrame:
    """Cohort by activity month. Rows are customers, so counting them counts customers once.

    A cohort's size is the number of its customers active in the cohort month itself: the
    month that defines a cohort is by construction a month with an order.
    """
    grouped = months.groupBy("cohort_month", "activity_month").agg(
        F.count(F.lit(1)).alias("active_customers"),
        money(F.sum("revenue")).alias("revenue"),
        money(F.sum("margin")).alias("margin"),
        F.sum("orders").alias("orders"),
    )
    first_month = F.when(
        F.col("activity_month") == F.col("cohort_month"), F.col("active_customers")
    )
    # The window runs over months by months, whatever the number of customers.
    return grouped.withColumn(
        "cohort_customers", F.max(first_month).over(Window.partitionBy("cohort_month"))
    ).withColumn("months_since_acquisition", month_starts_between("cohort_month", "activity_month"))


def customer_cohort_retention(economics: DataFrame) -> DataFrame:
    return (
        cohort_months(customer_months(economics))
        .select(
            "cohort_month",
            "activity_month",
            "months_since_acquisition",
            "cohort_customers",
            "active_customers",
            F.col("revenue").alias("cohort_revenue"),
            F.col("orders").alias("orders_in_period"),
            ratio_or_null("active_customers", "cohort_customers").alias("retention_rate"),
        )
        .orderBy("cohort_month", "months_since_acquisition")
    )


def rfm_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    """Lifecycle segments, the first rule that holds wins."""
    return (
        F.when((recency >= 4) & (frequency >= 4) & (monetary >= 4), "Champions")
        .when((recency >= 3) & (frequency >= 4), "Loyal")
        .when((recency >= 4) & (frequency <= 2), "New")
        .when((recency <= 2) & (frequency >= 4), "At Risk")
        .when((recency <= 2) & (frequency <= 2), "Hibernating")
        .otherwise("Active")
    )


def customer_rfm(history: DataFrame, as_of: date) -> DataFrame:
    """Quintile scores; ties are ordered by customer id. Five is most recent, most often, most."""
    base = history.select(
        "customer_id",
        days_between("last_order_date", F.lit(as_of)).alias("recency_days"),
        F.col("lifetime_order_count").alias("frequency"),
        F.col("lifetime_net_subtotal").alias("monetary"),
    )
    scored = ntile_scores(
        base,
        "customer_id",
        {
            "recency_score": ("recency_days", False),
            "frequency_score": ("frequency", True),
            "monetary_score": ("monetary", True),
        },
        buckets=5,
    )
    scores = [F.col(f"{name}_score") for name in ("recency", "frequency", "monetary")]
    return scored.withColumns(
        {
            "rfm_cell": F.concat(*[s.cast("string") for s in scores]),
            "rfm_segment": rfm_segment(*scores),
        }
    )
