"""The staging layer as permanent views of the catalog, over raw feeds that are catalog tables.

A view of a DataFrame ends with its session. These are SQL text kept by the catalog, so any session, and any
tool that speaks to the catalog, reads them. They follow a feed that is loaded again; a session that has
read the feed before then refreshes its table.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemart.functions.columns import DIRECT_SOURCE, NO_CAMPAIGN, NO_MEDIUM
from tidemart.plans.documentation import COLUMN_COMMENTS, PERSONAL_DATA, TABLE_COMMENTS
from tidemart.plans.staging import ADS_PLATFORM, EMAIL_EVENT_TYPES, FUNNEL_EVENTS, REFUNDED_STATUSES, SESSION_KEY
from tidemart.sources.schemas import RAW_TABLE_GROUP


def _filled(column: str, placeholder: str) -> str:
    return f"coalesce(nullif({column}, ''), '{placeholder}') as {column}"


def _blank(column: str) -> str:
    return f"nullif({column}, '') as {column}"


def _ratio(top: str, bottom: str) -> str:
    return f"if({bottom} > 0, double({top}) / double({bottom}), null)"


_EMAIL = "nullif(trim(lower(email)), '') as email"
_SPELLED = " ".join(f"when '{name}' then '{spelling}'" for name, spelling in EMAIL_EVENT_TYPES.items())
_FLAGS = ", ".join(f"int(bool_or(event_name = '{name}')) as had_{name}" for name in FUNNEL_EVENTS)
_REFUNDED = ", ".join(f"'{status}'" for status in REFUNDED_STATUSES)

# The select list of each view over its feed.
PROJECTIONS: dict[str, str] = {
    "orders": f"""
        order_id, order_number, customer_id, created_at as ordered_at, processed_at, date(created_at) as order_date,
        financial_status, fulfillment_status, coalesce(financial_status in ({_REFUNDED}), false) as has_refund, currency,
        subtotal_price as order_subtotal, total_tax as order_tax, total_discounts as order_discount,
        total_shipping as order_shipping, total_price as order_total,
        cast(subtotal_price - total_discounts as decimal(18,2)) as net_merchandise_value,
        {_filled("utm_source", DIRECT_SOURCE)}, {_filled("utm_medium", NO_MEDIUM)},
        {_filled("utm_campaign", NO_CAMPAIGN)}, source_name, referring_site""",
    "order_lines": """
        order_line_id, order_id, product_id, sku, title as product_title, quantity, price as unit_price,
        total_discount as line_discount, cast(quantity * price as decimal(18,2)) as gross_line_revenue,
        cast(quantity * price - total_discount as decimal(18,2)) as net_line_revenue""",
    "customers": f"""
        customer_id, {_EMAIL}, first_name, last_name, {_blank("phone")}, country_code, accepts_marketing,
        created_at as customer_created_at, updated_at as customer_updated_at""",
    "products": f"""
        product_id, title as product_title, product_type, vendor, sku, currency, price as product_price,
        cost as product_cost, cast(price - cost as decimal(18,2)) as product_unit_margin,
        {_ratio("cast(price - cost as decimal(18,2))", "price")} as product_margin_pct,
        status as product_status, created_at as product_created_at""",
    "refunds": """
        refund_id, order_id, created_at as refunded_at, date(created_at) as refund_date, refund_amount,
        reason as refund_reason""",
    "email_events": f"""
        event_id, profile_id, {_EMAIL},
        case event_name {_SPELLED} else lower(replace(event_name, ' ', '_')) end as event_type, event_at,
        date(event_at) as event_date, coalesce(event_value, 0) as event_value, {_blank("campaign_id")}, {_blank("flow_id")},
        {_blank("message_id")}, {_blank("attributed_order_id")},
        case when campaign_id <> '' then 'campaign' when flow_id <> '' then 'flow' else 'other' end as message_source""",
    "email_campaigns": """
        campaign_id, name as campaign_name, subject_line, channel, sent_at, date(sent_at) as sent_date, recipient_count""",
    "email_flows": "flow_id, name as flow_name, trigger_type, status",
    "email_profiles": f"profile_id, {_EMAIL}, created_at as profile_created_at, accepts_marketing, country_code",
    "ad_campaigns": f"""
        campaign_id, name as campaign_name, objective as campaign_objective, status as campaign_status, daily_budget,
        utm_campaign, created_at as campaign_created_at, '{ADS_PLATFORM}' as platform""",
    "ad_sets": """
        ad_set_id, campaign_id, name as ad_set_name, optimization_goal, status as ad_set_status,
        created_at as ad_set_created_at""",
    "ads": "ad_id, ad_set_id, name as ad_name, creative_type, status as ad_status, created_at as ad_created_at",
    "ad_insights": f"""
        date_day, campaign_id, ad_set_id, ad_id, impressions, clicks, spend, reported_conversions,
        reported_conversion_value, coalesce({_ratio("clicks", "impressions")}, 0d) as ctr,
        coalesce({_ratio("double(spend) * 1000d", "impressions")}, 0d) as cpm, {_ratio("spend", "clicks")} as cpc,
        coalesce({_ratio("reported_conversion_value", "spend")}, 0d) as platform_reported_roas,
        '{ADS_PLATFORM}' as platform""",
    "web_events": f"""
        event_id, event_name, event_timestamp, date(event_timestamp) as event_date, user_pseudo_id, session_id,
        page_location, page_title, {_filled("source", DIRECT_SOURCE)}, {_filled("medium", NO_MEDIUM)},
        {_filled("campaign", NO_CAMPAIGN)}, ga_session_number, coalesce(event_value, 0) as event_value,
        coalesce(items_count, 0) as items_count""",
}
# A view over the view of the events.
_SESSIONS = f"""
    select {", ".join(SESSION_KEY)}, session_started_at, date(session_started_at) as session_date, session_ended_at,
        session_number, first.source as session_source, first.medium as session_medium,
        first.campaign as session_campaign, {", ".join(f"had_{name}" for name in FUNNEL_EVENTS)}, page_view_count,
        cast(purchases as decimal(18,2)) as purchase_value
    from (
        select {", ".join(SESSION_KEY)}, min(event_timestamp) as session_started_at,
            max(event_timestamp) as session_ended_at, max(ga_session_number) as session_number,
            min_by(struct(source, medium, campaign), struct(event_timestamp is null, event_timestamp, event_id)) as first,
            {_FLAGS}, count_if(event_name = 'page_view') as page_view_count,
            sum(if(event_name = 'purchase', event_value, 0)) as purchases
        from __events__ group by {", ".join(SESSION_KEY)}
    )
"""


def _columns_with_comments(spark: SparkSession, select: str) -> str:
    """The column list of a view, with comments; personal data is said in words."""
    columns = []
    for name in spark.sql(select).columns:
        texts = [COLUMN_COMMENTS.get(name), "Personal data." if name in PERSONAL_DATA else None]
        comment = " ".join(t for t in texts if t).replace("'", "\\'")
        columns.append(f"`{name}` COMMENT '{comment}'" if comment else f"`{name}`")
    return ", ".join(columns)


def create_permanent_views(spark: SparkSession, schema: str = "staging", feeds: str | None = None) -> list[str]:
    """Create or replace one view per staging model in ``schema``; returns their names.

    The raw feeds are read as ``<group>.<table>``, the names of ``write_catalog_feeds``, or all from the schema ``feeds``.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    selects = {
        f"stg_{feed}": f"select {text.strip()} from {feeds or RAW_TABLE_GROUP[feed]}.{feed}"
        for feed, text in PROJECTIONS.items()
    }
    selects["stg_web_sessions"] = _SESSIONS.replace("__events__", f"{schema}.stg_web_events")
    for name, select in selects.items():
        comment = TABLE_COMMENTS[name].replace("'", "\\'")
        columns = _columns_with_comments(spark, select)
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} ({columns}) COMMENT '{comment}' AS {select}")
    return [f"{schema}.{name}" for name in selects]
