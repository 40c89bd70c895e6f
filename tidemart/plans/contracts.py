"""What each table promises. Tables, columns, bounds and vocabularies."""

from __future__ import annotations

# Single-column keys. Nulls are left to NOT_NULL.
UNIQUE: dict[str, tuple[str, ...]] = {
    "raw_orders": ("order_id",),
    "raw_order_lines": ("order_line_id",),
    "raw_customers": ("customer_id",),
    "raw_products": ("product_id",),
    "raw_refunds": ("refund_id",),
    "raw_email_events": ("event_id",),
    "raw_email_campaigns": ("campaign_id",),
    "raw_email_flows": ("flow_id",),
    "raw_email_profiles": ("profile_id",),
    "raw_ad_campaigns": ("campaign_id",),
    "raw_ad_sets": ("ad_set_id",),
    "raw_ads": ("ad_id",),
    "raw_web_events": ("event_id",),
    "raw_countries": ("country_code",),
    "stg_orders": ("order_id",),
    "stg_order_lines": ("order_line_id",),
    "stg_customers": ("customer_id",),
    "stg_products": ("product_id",),
    "stg_refunds": ("refund_id",),
    "stg_email_events": ("event_id",),
    "stg_email_campaigns": ("campaign_id",),
    "stg_email_flows": ("flow_id",),
    "stg_email_profiles": ("profile_id",),
    "stg_ad_campaigns": ("campaign_id",),
    "stg_ad_sets": ("ad_set_id",),
    "stg_ads": ("ad_id",),
    "stg_web_events": ("event_id",),
    "int_orders_joined": ("order_id",),
    "int_customer_order_history": ("customer_id",),
    "dim_dates": ("date_day",),
    "dim_customers": ("customer_id", "customer_sk"),
    "dim_products": ("product_id", "product_sk"),
    "fct_orders": ("order_id",),
    "fct_order_items": ("order_line_id",),
    "fct_attribution_first_touch": ("order_id",),
    "fct_attribution_last_touch": ("order_id",),
    "fct_blended_roas": ("date_day",),
    "customer_ltv": ("customer_id",),
    "customer_rfm": ("customer_id",),
}

UNIQUE_COMBINATIONS: dict[str, tuple[str, ...]] = {
    "stg_web_sessions": ("user_pseudo_id", "session_id"),
    "fct_marketing_performance": ("date_day", "platform", "campaign_id"),
    "customer_cohort_retention": ("cohort_month", "months_since_acquisition"),
}

NOT_NULL: dict[str, tuple[str, ...]] = {
    "raw_orders": ("order_id", "customer_id"),
    "raw_order_lines": ("order_line_id", "order_id"),
    "raw_customers": ("customer_id", "email"),
    "raw_products": ("product_id",),
    "raw_refunds": ("refund_id",),
    "raw_email_events": ("event_id", "profile_id"),
    "raw_email_campaigns": ("campaign_id",),
    "raw_email_flows": ("flow_id",),
    "raw_email_profiles": ("profile_id", "email"),
    "raw_ad_campaigns": ("campaign_id",),
    "raw_ad_sets": ("ad_set_id",),
    "raw_ads": ("ad_id",),
    "raw_web_events": ("event_id",),
    "raw_countries": ("country_code",),
    "stg_orders": ("order_id", "ordered_at", "order_total"),
    "stg_order_lines": ("order_line_id", "order_id", "quantity"),
    "stg_customers": ("customer_id", "email"),
    "stg_products": ("product_id",),
    "stg_refunds": ("refund_id", "order_id"),
    "stg_email_events": ("event_id", "email"),
    "stg_email_campaigns": ("campaign_id",),
    "stg_email_flows": ("flow_id",),
    "stg_email_profiles": ("profile_id", "email"),
    "stg_ad_campaigns": ("campaign_id",),
    "stg_ad_sets": ("ad_set_id",),
    "stg_ads": ("ad_id",),
    "stg_ad_insights": ("date_day", "spend"),
    "stg_web_events": ("event_id", "event_name"),
    "stg_web_sessions": ("session_id", "user_pseudo_id", "session_started_at"),
    "int_orders_joined": ("order_id", "customer_id", "net_subtotal_after_refunds"),
    "int_unified_spend": ("date_day", "platform", "spend"),
    "int_customer_order_history": ("customer_id", "lifetime_order_count"),
    "int_sessions_attributed": ("session_id",),
    "dim_dates": ("date_day",),
    "dim_customers": ("customer_id", "customer_sk", "email", "lifetime_order_count"),
    "dim_products": ("product_id", "product_sk"),
    "fct_orders": (
        "order_id", "customer_id", "net_subtotal_after_refunds", "order_cogs", "contribution_margin",
    ),
    "fct_order_items": ("order_line_id", "line_gross_margin"),
    "fct_marketing_performance": ("date_day", "campaign_id", "spend"),
    "fct_attribution_first_touch": ("order_id", "first_touch_source"),
    "fct_attribution_last_touch": ("order_id", "last_touch_source"),
    "fct_blended_roas": ("date_day",),
    "customer_ltv": ("customer_id", "ltv_revenue_total"),
    "customer_cohort_retention": ("cohort_month", "months_since_acquisition", "retention_rate"),
    "customer_rfm": ("customer_id",),
}

# Nulls pass.
ACCEPTED_VALUES: dict[tuple[str, str], tuple[str, ...]] = {
    ("stg_orders", "financial_status"): (
        "paid", "pending", "refunded", "partially_refunded", "voided", "authorized",
    ),
    ("stg_email_events", "event_type"): (
        "placed_order", "started_checkout", "received_email", "opened_email", "clicked_email",
        "received_sms", "subscribed_to_list",
    ),
    ("stg_email_campaigns", "channel"): ("email", "sms"),
    ("stg_email_flows", "status"): ("active", "draft", "archived"),
    ("stg_web_events", "event_name"): (
        "session_start", "page_view", "view_item", "add_to_cart", "begin_checkout", "purchase",
        "scroll", "click", "user_engagement",
    ),
    ("customer_rfm", "rfm_segment"): (
        "Champions", "Loyal", "New", "At Risk", "Hibernating", "Active",
    ),
}

# Inclusive bounds, None is open. Nulls pass.
BETWEEN: dict[tuple[str, str], tuple[int | None, int | None]] = {
    ("raw_orders", "total_price"): (0, None),
    ("raw_order_lines", "quantity"): (1, None),
    ("raw_ad_insights", "spend"): (0, None),
    ("stg_orders", "order_total"): (0, None),
    ("stg_order_lines", "quantity"): (1, None),
    ("stg_refunds", "refund_amount"): (0, None),
    ("stg_email_events", "event_value"): (0, None),
    ("stg_ad_insights", "spend"): (0, None),
    ("stg_ad_insights", "ctr"): (0, 1),
    ("int_unified_spend", "spend"): (0, None),
    ("int_customer_order_history", "lifetime_order_count"): (1, None),
    ("dim_products", "product_margin_pct"): (0, 1),
    ("fct_orders", "contribution_margin_pct"): (-1, 1),
    ("fct_marketing_performance", "spend"): (0, None),
    ("customer_cohort_retention", "retention_rate"): (0, 1),
}

# (child table, column) -> (parent table, column). Null children pass.
RELATIONSHIPS: dict[tuple[str, str], tuple[str, str]] = {
    ("raw_order_lines", "order_id"): ("raw_orders", "order_id"),
    ("raw_order_lines", "product_id"): ("raw_products", "product_id"),
    ("raw_refunds", "order_id"): ("raw_orders", "order_id"),
    ("raw_ad_sets", "campaign_id"): ("raw_ad_campaigns", "campaign_id"),
    ("raw_ads", "ad_set_id"): ("raw_ad_sets", "ad_set_id"),
    ("stg_order_lines", "order_id"): ("stg_orders", "order_id"),
    ("stg_order_lines", "product_id"): ("stg_products", "product_id"),
    ("stg_refunds", "order_id"): ("stg_orders", "order_id"),
    ("stg_ad_sets", "campaign_id"): ("stg_ad_campaigns", "campaign_id"),
    ("stg_ads", "ad_set_id"): ("stg_ad_sets", "ad_set_id"),
    ("stg_ad_insights", "campaign_id"): ("stg_ad_campaigns", "campaign_id"),
    ("fct_orders", "customer_id"): ("dim_customers", "customer_id"),
    ("fct_order_items", "order_id"): ("fct_orders", "order_id"),
    ("fct_order_items", "product_id"): ("dim_products", "product_id"),
}

# Raw table -> (load-time column, hours until a warning, hours until an error). Some feeds
# name a column they do not carry; the check reports that as an error.
FRESHNESS: dict[str, tuple[str, int, int]] = {
    "raw_orders": ("updated_at", 6, 24),
    "raw_order_lines": ("updated_at", 6, 24),
    "raw_customers": ("updated_at", 6, 24),
    "raw_products": ("updated_at", 6, 24),
    "raw_refunds": ("updated_at", 6, 24),
    "raw_email_events": ("event_at", 12, 36),
    "raw_email_campaigns": ("sent_at", 12, 36),
    "raw_email_profiles": ("created_at", 12, 36),
    "raw_ad_campaigns": ("date_day", 12, 36),
    "raw_ad_sets": ("date_day", 12, 36),
    "raw_ads": ("date_day", 12, 36),
    "raw_ad_insights": ("date_day", 12, 36),
    "raw_web_events": ("event_timestamp", 36, 72),
}
