"""Raw table schemas, declared once so that no reader infers a type."""

from __future__ import annotations

# Table names, columns and types of the raw feeds, grouped by source system.
_FEEDS: dict[str, dict[str, str]] = {
    "commerce": {
        "orders": """order_id string, order_number int, customer_id string,
            created_at timestamp_ntz, processed_at timestamp_ntz, financial_status string,
            fulfillment_status string, currency string, subtotal_price decimal(12,2),
            total_tax decimal(12,2), total_discounts decimal(12,2), total_shipping decimal(12,2),
            total_price decimal(12,2), source_name string, referring_site string,
            utm_source string, utm_medium string, utm_campaign string""",
        "order_lines": """order_line_id string, order_id string, product_id string, sku string,
            title string, quantity int, price decimal(12,2), total_discount decimal(12,2)""",
        "customers": """customer_id string, email string, first_name string, last_name string,
            phone string, country_code string, accepts_marketing boolean,
            created_at timestamp_ntz, updated_at timestamp_ntz""",
        "products": """product_id string, title string, product_type string, vendor string,
            sku string, price decimal(12,2), cost decimal(12,2), currency string, status string,
            created_at timestamp_ntz""",
        "refunds": """refund_id string, order_id string, created_at timestamp_ntz,
            refund_amount decimal(12,2), reason string""",
    },
    "email": {
        "email_events": """event_id string, profile_id string, email string, event_name string,
            event_at timestamp_ntz, event_value decimal(12,2), campaign_id string, flow_id string,
            message_id string, attributed_order_id string""",
        "email_campaigns": """campaign_id string, name string, subject_line string,
            channel string, sent_at timestamp_ntz, recipient_count int""",
        "email_flows": "flow_id string, name string, trigger_type string, status string",
        "email_profiles": """profile_id string, email string, created_at timestamp_ntz,
            accepts_marketing boolean, country_code string""",
    },
    "ads": {
        "ad_campaigns": """campaign_id string, name string, objective string, status string,
            daily_budget decimal(12,2), utm_campaign string, created_at timestamp_ntz""",
        "ad_sets": """ad_set_id string, campaign_id string, name string,
            optimization_goal string, status string, created_at timestamp_ntz""",
        "ads": """ad_id string, ad_set_id string, name string, creative_type string,
            status string, created_at timestamp_ntz""",
        "ad_insights": """date_day date, campaign_id string, ad_set_id string, ad_id string,
            impressions int, clicks int, spend decimal(12,2), reported_conversions int,
            reported_conversion_value decimal(12,2)""",
    },
    "web": {
        "web_events": """event_id string, event_name string, event_timestamp timestamp_ntz,
            user_pseudo_id string, session_id string, page_location string, page_title string,
            source string, medium string, campaign string, ga_session_number int,
            event_value decimal(12,2), items_count int""",
    },
    "reference": {
        "countries": "country_code string, country_name string, region string",
    },
}

RAW_SCHEMAS: dict[str, str] = {
    table: ddl for feed in _FEEDS.values() for table, ddl in feed.items()
}

RAW_TABLE_GROUP: dict[str, str] = {
    table: f"raw_{feed}" for feed, tables in _FEEDS.items() for table in tables
}
