"""Staging: rename, cast and normalise one raw table at a time.

Everything here is a narrow projection that Catalyst folds into the scan of whatever
reads it, except ``web_sessions``, which is one grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import (
    DIRECT_SOURCE,
    MONEY,
    NO_CAMPAIGN,
    NO_MEDIUM,
    blank_to,
    blank_to_null,
    earliest,
    flag_any,
    normalize_email,
    ratio_or_null,
    ratio_or_zero,
    sum_money,
    zero_if_null,
)

# Financial statuses that mark an order as refunded.
REFUNDED_STATUSES = ("refunded", "partially_refunded")

# Email event names with a controlled spelling.
EMAIL_EVENT_TYPES = {
    "Placed Order": "placed_order",
    "Started Checkout": "started_checkout",
    "Received Email": "received_email",
    "Opened Email": "opened_email",
    "Clicked Email": "clicked_email",
    "Received SMS": "received_sms",
    "Subscribed to List": "subscribed_to_list",
}

ADS_PLATFORM = "meta_ads"


def merchandise_value(subtotal: str, discount: str) -> Column:
    return (F.col(subtotal) - F.col(discount)).cast(MONEY)


def orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "order_number",
        "customer_id",
        F.col("created_at").alias("ordered_at"),
        "processed_at",
        F.to_date("created_at").alias("order_date"),
        "financial_status",
        "fulfillment_status",
        F.coalesce(F.col("financial_status").isin(*REFUNDED_STATUSES), F.lit(False)).alias("has_refund"),
        "currency",
        F.col("subtotal_price").alias("order_subtotal"),
        F.col("total_tax").alias("order_tax"),
        F.col("total_discounts").alias("order_discount"),
        F.col("total_shipping").alias("order_shipping"),
        F.col("total_price").alias("order_total"),
        merchandise_value("subtotal_price", "total_discounts").alias("net_merchandise_value"),
        blank_to("utm_source", DIRECT_SOURCE).alias("utm_source"),
        blank_to("utm_medium", NO_MEDIUM).alias("utm_medium"),
        blank_to("utm_campaign", NO_CAMPAIGN).alias("utm_campaign"),
        "source_name",
        "referring_site",
    )


def order_lines(raw: DataFrame) -> DataFrame:
    gross = F.col("quantity") * F.col("price")
    return raw.select(
        "order_line_id",
        "order_id",
        "product_id",
        "sku",
        F.col("title").alias("product_title"),
        "quantity",
        F.col("price").alias("unit_price"),
        F.col("total_discount").alias("line_discount"),
        gross.cast(MONEY).alias("gross_line_revenue"),
        (gross - F.col("total_discount")).cast(MONEY).alias("net_line_revenue"),
    )


def customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        normalize_email("email").alias("email"),
        "first_name",
        "last_name",
        blank_to_null("phone").alias("phone"),
        "country_code",
        "accepts_marketing",
        F.col("created_at").alias("customer_created_at"),
        F.col("updated_at").alias("customer_updated_at"),
    )


def products(raw: DataFrame) -> DataFrame:
    unit_margin = (F.col("price") - F.col("cost")).cast(MONEY)
    return raw.select(
        "product_id",
        F.col("title").alias("product_title"),
        "product_type",
        "vendor",
        "sku",
        "currency",
        F.col("price").alias("product_price"),
        F.col("cost").alias("product_cost"),
        unit_margin.alias("product_unit_margin"),
        ratio_or_null(unit_margin, "price").alias("product_margin_pct"),
        F.col("status").alias("product_status"),
        F.col("created_at").alias("product_created_at"),
    )


def refunds(raw: DataFrame) -> DataFrame:
    return raw.select(
        "refund_id",
        "order_id",
        F.col("created_at").alias("refunded_at"),
        F.to_date("created_at").alias("refund_date"),
        "refund_amount",
        F.col("reason").alias("refund_reason"),
    )


def email_events(raw: DataFrame) -> DataFrame:
    event_type = F.lower(F.replace(F.col("event_name"), F.lit(" "), F.lit("_")))
    for name, spelling in EMAIL_EVENT_TYPES.items():
        event_type = F.when(F.col("event_name") == name, spelling).otherwise(event_type)
    campaign, flow = blank_to_null("campaign_id"), blank_to_null("flow_id")
    return raw.select(
        "event_id",
        "profile_id",
        normalize_email("email").alias("email"),
        event_type.alias("event_type"),
        "event_at",
        F.to_date("event_at").alias("event_date"),
        zero_if_null("event_value").alias("event_value"),
        campaign.alias("campaign_id"),
        flow.alias("flow_id"),
        blank_to_null("message_id").alias("message_id"),
        blank_to_null("attributed_order_id").alias("attributed_order_id"),
        F.when(campaign.isNotNull(), "campaign")
        .when(flow.isNotNull(), "flow")
        .otherwise("other")
        .alias("message_source"),
    )


def email_campaigns(raw: DataFrame) -> DataFrame:
    return raw.select(
        "campaign_id",
        F.col("name").alias("campaign_name"),
        "subject_line",
        "channel",
        "sent_at",
        F.to_date("sent_at").alias("sent_date"),
        "recipient_count",
    )


def email_flows(raw: DataFrame) -> DataFrame:
    return raw.select("flow_id", F.col("name").alias("flow_name"), "trigger_type", "status")


def email_profiles(raw: DataFrame) -> DataFrame:
    return raw.select(
        "profile_id",
        normalize_email("email").alias("email"),
        F.col("created_at").alias("profile_created_at"),
        "accepts_marketing",
        "country_code",
    )


def ad_campaigns(raw: DataFrame) -> DataFrame:
    return raw.select(
        "campaign_id",
        F.col("name").alias("campaign_name"),
        F.col("objective").alias("campaign_objective"),
        F.col("status").alias("campaign_status"),
        "daily_budget",
        "utm_campaign",
        F.col("created_at").alias("campaign_created_at"),
        F.lit(ADS_PLATFORM).alias("platform"),
    )


def ad_sets(raw: DataFrame) -> DataFrame:
    return raw.select(
        "ad_set_id",
        "campaign_id",
        F.col("name").alias("ad_set_name"),
        "optimization_goal",
        F.col("status").alias("ad_set_status"),
        F.col("created_at").alias("ad_set_created_at"),
    )


def ads(raw: DataFrame) -> DataFrame:
    return raw.select(
        "ad_id",
        "ad_set_id",
        F.col("name").alias("ad_name"),
        "creative_type",
        F.col("status").alias("ad_status"),
        F.col("created_at").alias("ad_created_at"),
    )


def ad_insights(raw: DataFrame) -> DataFrame:
    spend_per_thousand = F.col("spend").cast("double") * 1000.0
    return raw.select(
        "date_day",
        "campaign_id",
        "ad_set_id",
        "ad_id",
        "impressions",
        "clicks",
        "spend",
        "reported_conversions",
        "reported_conversion_value",
        ratio_or_zero("clicks", "impressions").alias("ctr"),
        ratio_or_zero(spend_per_thousand, "impressions").alias("cpm"),
        ratio_or_null("spend", "clicks").alias("cpc"),
        ratio_or_zero("reported_conversion_value", "spend").alias("platform_reported_roas"),
        F.lit(ADS_PLATFORM).alias("platform"),
    )


def web_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        "event_name",
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        "user_pseudo_id",
        "session_id",
        "page_location",
        "page_title",
        blank_to("source", DIRECT_SOURCE).alias("source"),
        blank_to("medium", NO_MEDIUM).alias("medium"),
        blank_to("campaign", NO_CAMPAIGN).alias("campaign"),
        "ga_session_number",
        zero_if_null("event_value").alias("event_value"),
        zero_if_null("items_count").alias("items_count"),
    )


# Event names that become ``had_<name>`` flags of a session.
FUNNEL_EVENTS = ("page_view", "view_item", "add_to_cart", "begin_checkout", "purchase")

SESSION_KEY = ("user_pseudo_id", "session_id")


def web_sessions(events: DataFrame) -> DataFrame:
    """One row per (user, session), attributed to the session's first event.

    The first event is picked by an aggregate rather than a ranking window, so a session
    holding a large share of all events is reduced before the shuffle. Events at the same
    instant are ordered by ``event_id``.
    """
    first = F.min_by(
        F.struct("source", "medium", "campaign"), earliest("event_timestamp", "event_id")
    )
    named = F.col("event_name")
    purchase_value = F.when(named == "purchase", F.col("event_value")).otherwise(0)
    grouped = events.groupBy(*SESSION_KEY).agg(
        F.min("event_timestamp").alias("session_started_at"),
        F.max("event_timestamp").alias("session_ended_at"),
        F.max("ga_session_number").alias("session_number"),
        first.alias("first"),
        *[flag_any(named == name).alias(f"had_{name}") for name in FUNNEL_EVENTS],
        F.count(F.when(named == "page_view", 1)).alias("page_view_count"),
        sum_money(purchase_value).cast(MONEY).alias("purchase_value"),
    )
    return grouped.select(
        *SESSION_KEY,
        "session_started_at",
        F.to_date("session_started_at").alias("session_date"),
        "session_ended_at",
        "session_number",
        F.col("first.source").alias("session_source"),
        F.col("first.medium").alias("session_medium"),
        F.col("first.campaign").alias("session_campaign"),
        *[f"had_{name}" for name in FUNNEL_EVENTS],
        "page_view_count",
        "purchase_value",
    )
