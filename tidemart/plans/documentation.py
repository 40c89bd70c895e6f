"""Documentation carried in the schema and, for catalog tables, as comments."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMN_COMMENTS: dict[str, str] = {
    "customer_sk": "MD5 surrogate of customer_id for use in BI joins.",
    "product_sk": "MD5 surrogate of product_id for use in BI joins.",
    "acquisition_source": "UTM source of the customer's first order.",
    "refund_amount": "All refunds booked against the order.",
    "net_subtotal_after_refunds": "Order subtotal less refunds: the revenue figure of every mart.",
    "order_cogs": "Units times product cost over the order's lines; unknown costs count as zero.",
    "contribution_margin": "Net revenue less cost of goods.",
    "contribution_margin_pct": "Contribution margin over net revenue, zero when revenue is not positive.",
    "product_margin_pct": "Unit margin over price, null when the price is not positive.",
    "platform_reported_roas": "Conversion value the ad platform claims, over spend.",
    "last_touch_roas": "Revenue of orders carrying the campaign's UTM tag, over spend.",
    "cac_last_touch": "Spend per new customer acquired through the campaign's UTM tag.",
    "blended_roas": "All revenue over all paid spend, null without spend.",
    "contribution_margin_mer": "All contribution margin over all paid spend, null without spend.",
    "retention_rate": "Share of the cohort with an order in the month.",
    "rfm_cell": "Recency, frequency and monetary quintiles as three digits; 5 is best.",
    "rfm_segment": "Lifecycle segment derived from the three quintiles.",
    "first_touch_source": "Source credited with acquiring the customer.",
    "last_touch_source": "Source captured at this order's checkout.",
    "line_gross_margin": "Net line revenue less cost of goods.",
}

TABLE_COMMENTS: dict[str, str] = {
    "stg_orders": "One row per order with refund flag, merchandise value and filled-in UTM fields.",
    "stg_order_lines": "One row per order line with gross and net revenue.",
    "stg_customers": "One row per customer; e-mail lower-cased and trimmed.",
    "stg_products": "One row per product with unit margin.",
    "stg_refunds": "One row per refund.",
    "stg_email_events": "One row per e-mail or text-message event, event types spelled one way.",
    "stg_email_campaigns": "One row per e-mail campaign.",
    "stg_email_flows": "One row per automated e-mail flow.",
    "stg_email_profiles": "One row per e-mail profile.",
    "stg_ad_campaigns": "One row per ad campaign.",
    "stg_ad_sets": "One row per ad set.",
    "stg_ads": "One row per ad.",
    "stg_ad_insights": "Daily results per ad with click rate, costs and reported return.",
    "stg_web_events": "One row per web event with filled-in source, medium and campaign.",
    "stg_web_sessions": "One row per user and session, credited to the session's first event.",
    "fct_orders": "One row per order: revenue net of refunds, cost of goods and margin.",
    "fct_order_items": "One row per order line with product cost and gross margin.",
    "dim_customers": "One row per customer with identity, geography and lifetime totals.",
    "dim_products": "One row per product with price, cost and margin.",
    "dim_dates": "One row per day of the project's calendar.",
    "fct_marketing_performance": "Daily spend per campaign beside platform-reported and UTM-matched revenue.",
    "fct_attribution_first_touch": "Each member order credited to the customer's first-order channel.",
    "fct_attribution_last_touch": "Each order credited to its own channel.",
    "fct_blended_roas": "All revenue against all paid spend per day.",
    "customer_ltv": "Revenue and margin per customer within day windows after the first order.",
    "customer_cohort_retention": "Acquisition month by active month: customers, revenue and retention.",
    "customer_rfm": "Recency, frequency and monetary quintiles with a lifecycle segment.",
}

PERSONAL_DATA = frozenset({"email", "phone", "customer_email"})


def documented(df: DataFrame) -> DataFrame:
    """Attach comments and personal-data tags; values and types stay as they are."""
    columns = []
    for name in df.columns:
        metadata: dict[str, object] = {}
        if name in COLUMN_COMMENTS:
            metadata["comment"] = COLUMN_COMMENTS[name]
        if name in PERSONAL_DATA:
            metadata["contains_pii"] = True
        if not metadata and df.schema[name].metadata:
            # What the column it was made from says does not hold for it.
            metadata["contains_pii"] = False
        columns.append(F.col(name).alias(name, metadata=metadata) if metadata else F.col(name))
    return df.select(*columns)


def documentation_of(spark: SparkSession, schemas: Iterable[str]) -> DataFrame:
    """What the catalog says about its tables: one row per column, and one per table without a column name.

    Returns ``schema_name, table_name, column_name, comment, personal_data``; views and tables alike, read
    from the catalog alone. Comments are null where there are none.
    """
    rows = []
    for schema in schemas:
        for table in spark.catalog.listTables(schema):
            if table.isTemporary:
                continue
            rows.append((schema, table.name, None, table.description, False))
            for field in spark.table(f"{schema}.{table.name}").schema:
                tagged = bool(field.metadata.get("contains_pii", False))
                rows.append((schema, table.name, field.name, field.metadata.get("comment"), tagged))
    kinds = "schema_name string, table_name string, column_name string, comment string, personal_data boolean"
    return spark.createDataFrame(rows, kinds)
