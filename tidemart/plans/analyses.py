"""The two standing analyses: monthly business review and cohort payback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.columns import (
    MONEY_SUM,
    cents,
    count_if,
    money,
    month_start,
    ratio_of_sums,
    ratio_or_null,
    sum_money,
)
from tidemart.plans.customer import cohort_months, customer_months
from tidemart.plans.intermediate import with_first_value


def monthly_spend(spend: DataFrame) -> DataFrame:
    return spend.groupBy(month_start("date_day").alias("month_start_date")).agg(
        sum_money("spend").alias("ad_spend")
    )


def monthly_business_review(
    calendar: DataFrame, economics: DataFrame, spend: DataFrame
) -> DataFrame:
    """Headline numbers per calendar month that has orders.

    One pass over orders serves revenue, new customers and repeat orders: rows are grouped
    per customer and day, tagged with the customer's first day, then summed per month.
    """
    per_day = economics.groupBy("customer_id", "order_date").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("order_subtotal").alias("priced_orders"),
        F.sum(cents("order_subtotal")).alias("gross"),
        F.sum(cents("net_subtotal_after_refunds")).alias("net"),
        F.sum(cents("contribution_margin")).alias("margin"),
    )
    dated = with_first_value(per_day, "order_date", "first_order_date", has_guests=True)
    first, day = F.col("first_order_date"), F.col("order_date")
    monthly = dated.groupBy(month_start("order_date").alias("month_start_date")).agg(
        money(F.sum("gross")).alias("gross_revenue"),
        money(F.sum("net")).alias("net_revenue"),
        money(F.sum("margin")).alias("contribution_margin"),
        F.sum("orders").alias("orders"),
        count_if(first == day).alias("new_customers"),
        F.coalesce(F.sum(F.when(first < day, F.col("orders"))), F.lit(0)).alias("repeat_orders"),
        F.coalesce(ratio_of_sums(money(F.sum("gross")), F.sum("priced_orders")), F.lit(0.0)).alias("aov"),
    )
    months = calendar.select("month_start_date").distinct()
    ad_spend = F.coalesce(F.col("ad_spend"), F.lit(0)).cast(MONEY_SUM)
    return (
        months.join(monthly, "month_start_date")
        .join(monthly_spend(spend), "month_start_date", "left")
        .withColumn("ad_spend", ad_spend)
        .withColumn("blended_roas", ratio_or_null("net_revenue", "ad_spend"))
        .orderBy("month_start_date")
    )


def cohort_payback_curve(economics: DataFrame, spend: DataFrame) -> DataFrame:
    """Running margin per acquired customer against the spend of the acquisition month."""
    running = Window.partitionBy("cohort_month").orderBy("months_since_acquisition")
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    curve = cohort_months(customer_months(economics)).withColumn(
        "cum_contribution_margin", F.sum("margin").over(running).cast(MONEY_SUM)
    )
    spent = monthly_spend(spend).withColumnRenamed("month_start_date", "cohort_month")
    total = F.coalesce(F.col("ad_spend"), F.lit(0)).cast(MONEY_SUM)
    return (
        curve.join(spent, "cohort_month", "left")
        .select(
            "cohort_month",
            "months_since_acquisition",
            "cohort_customers",
            "cum_contribution_margin",
            ratio_or_null("cum_contribution_margin", "cohort_customers").alias(
                "cum_contribution_margin_per_customer"
            ),
            total.alias("cohort_total_spend"),
            ratio_or_null(total, "cohort_customers").alias("cohort_cac"),
        )
        .withColumn(
            "payback_ratio", ratio_or_null("cum_contribution_margin_per_customer", "cohort_cac")
        )
        .orderBy("cohort_month", "months_since_acquisition")
    )
