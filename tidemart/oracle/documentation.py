"""What the catalog must say about its tables, as SQL."""

from __future__ import annotations

from tidemart.plans.documentation import COLUMN_COMMENTS, TABLE_COMMENTS

# The schema of each table, and the documented columns it has.
TABLES: dict[str, str] = {
    "staging.stg_orders": "",
    "staging.stg_order_lines": "",
    "staging.stg_customers": "email phone",
    "staging.stg_products": "product_margin_pct",
    "staging.stg_refunds": "refund_amount",
    "staging.stg_email_events": "email",
    "staging.stg_email_campaigns": "",
    "staging.stg_email_flows": "",
    "staging.stg_email_profiles": "email",
    "staging.stg_ad_campaigns": "",
    "staging.stg_ad_sets": "",
    "staging.stg_ads": "",
    "staging.stg_ad_insights": "platform_reported_roas",
    "staging.stg_web_events": "",
    "staging.stg_web_sessions": "",
    "intermediate.int_customer_order_history": "acquisition_source",
    "marts_core.fct_orders": "refund_amount net_subtotal_after_refunds order_cogs contribution_margin"
    " contribution_margin_pct customer_email",
    "marts_core.fct_order_items": "line_gross_margin",
    "marts_core.dim_customers": "customer_sk email phone acquisition_source",
    "marts_core.dim_products": "product_sk product_margin_pct",
    "marts_core.dim_dates": "",
    "marts_marketing.fct_marketing_performance": "platform_reported_roas last_touch_roas cac_last_touch",
    "marts_marketing.fct_attribution_first_touch": "first_touch_source",
    "marts_marketing.fct_attribution_last_touch": "last_touch_source",
    "marts_marketing.fct_blended_roas": "blended_roas contribution_margin_mer",
    "marts_customer.customer_ltv": "",
    "marts_customer.customer_cohort_retention": "retention_rate",
    "marts_customer.customer_rfm": "rfm_cell rfm_segment",
}
# The columns with personal data.
PERSONAL = ("email", "phone", "customer_email")


def _quoted(text: str | None) -> str:
    return "null" if text is None else "'" + text.replace("'", "''") + "'"


def _rows() -> list[str]:
    rows = []
    for name, columns in TABLES.items():
        schema, table = name.split(".")
        if table in TABLE_COMMENTS:
            rows.append(f"('{schema}', '{table}', null, {_quoted(TABLE_COMMENTS[table])}, false)")
        for column in columns.split():
            comment, tagged = _quoted(COLUMN_COMMENTS.get(column)), str(column in PERSONAL).lower()
            rows.append(f"('{schema}', '{table}', '{column}', {comment}, {tagged})")
    return rows


DOCUMENTATION_SQL = (
    "select * from (values\n" + ",\n".join(_rows()) + "\n) as t(schema_name, table_name, column_name, comment, personal_data)"
)
