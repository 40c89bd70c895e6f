"""Edge cases with the expected rows worked out by hand."""

from collections import Counter
from datetime import date
from decimal import Decimal

from fixtures import models, order, rows
from pyspark.sql import functions as F


def D(text):
    return Decimal(text)


def test_utm_placeholders(spark):
    m = models(
        spark,
        orders=[
            order("o1", "c1", "2026-02-01 10:00:00", utm_source="", utm_medium="", utm_campaign=""),
            order("o2", "c1", "2026-02-02 10:00:00"),
            order("o3", "c1", "2026-02-03 10:00:00", utm_source="x", utm_medium="y", utm_campaign="z"),
        ],
    )
    blank = ("(direct)", "(none)", "(not set)")
    got = rows(m["stg_orders"], "order_id", "utm_source", "utm_medium", "utm_campaign")
    assert got == [("o1", *blank), ("o2", *blank), ("o3", "x", "y", "z")]


def test_refund_flag_follows_status_and_amount_follows_refunds(spark):
    m = models(
        spark,
        orders=[
            order("o1", "c1", "2026-02-01 10:00:00", 100),
            order("o2", "c1", "2026-02-02 10:00:00", 80, financial_status="refunded"),
        ],
        refunds=[
            {"refund_id": f"r{i}", "order_id": "o1", "created_at": "2026-02-05 00:00:00", "refund_amount": a}
            for i, a in enumerate([10, 20, "5.50"])
        ],
    )
    got = rows(
        m["int_orders_joined"],
        "order_id", "has_refund", "refund_amount", "refund_count", "net_subtotal_after_refunds",
    )
    assert got == [
        ("o1", False, D("35.50"), 3, D("64.50")),
        ("o2", True, D("0.00"), 0, D("80.00")),
    ]


def test_first_order_tie_goes_to_the_lower_id(spark):
    m = models(
        spark,
        orders=[
            order("o2", "c1", "2026-02-01 10:00:00", utm_source="late"),
            order("o1", "c1", "2026-02-01 10:00:00", utm_source="early"),
        ],
    )
    got = rows(
        m["int_customer_order_history"],
        "customer_id", "lifetime_order_count", "repeat_order_count", "is_repeat_customer",
        "acquisition_source",
    )
    assert got == [("c1", 2, 1, True, "early")]


def test_guest_orders(spark):
    m = models(
        spark,
        orders=[
            order("o1", None, "2026-02-01 10:00:00", utm_source="meta_ads", utm_campaign="q"),
            order("o2", "c1", "2026-02-01 11:00:00", utm_source="meta_ads", utm_campaign="q"),
        ],
        ad_campaigns=[{"campaign_id": "m1", "name": "Q", "utm_campaign": "q"}],
        ad_insights=[{"date_day": "2026-02-01", "campaign_id": "m1", "spend": 10, "impressions": 5, "clicks": 1}],
    )
    assert m["fct_orders"].count() == 2
    assert m["fct_attribution_last_touch"].count() == 2
    assert rows(m["fct_attribution_first_touch"], "order_id") == [("o2",)]
    assert rows(m["customer_ltv"], "customer_id") == [("c1",)]
    retention = m["customer_cohort_retention"]
    assert rows(retention, "cohort_customers", "active_customers", "orders_in_period") == [(1, 1, 1)]
    # Guests count as orders and revenue of the campaign, never as new customers.
    touched = rows(
        m["fct_marketing_performance"],
        "last_touch_orders", "last_touch_revenue", "last_touch_new_customers", "cac_last_touch",
    )
    assert touched == [(2, D("200.00"), 1, 10.0)]
    review = rows(m["monthly_business_review"], "orders", "new_customers", "repeat_orders")
    assert review == [(2, 1, 0)]


def test_customer_without_orders_and_unknown_country(spark):
    m = models(
        spark,
        customers=[
            {"customer_id": "c1", "first_name": "A", "last_name": "B", "country_code": "US", "email": " X@Y.z "},
            {"customer_id": "c2", "first_name": "C", "last_name": None, "country_code": "??"},
        ],
        countries=[{"country_code": "US", "country_name": "United States", "region": "NA"}],
        orders=[order("o1", "c1", "2026-02-01 10:00:00", 50)],
    )
    got = rows(
        m["dim_customers"],
        "customer_id", "email", "full_name", "country_name", "lifetime_order_count",
        "lifetime_net_revenue", "average_order_value", "is_repeat_customer", "first_order_date",
    )
    assert got == [
        ("c1", "x@y.z", "A B", "United States", 1, D("50.00"), 50.0, False, date(2026, 2, 1)),
        ("c2", None, None, None, 0, D("0.00"), 0.0, False, None),
    ]
    assert m["customer_rfm"].count() == m["customer_ltv"].count() == 1


def test_campaigns_sharing_a_tag_each_get_the_revenue(spark):
    m = models(
        spark,
        orders=[order("o1", "c1", "2026-02-01 10:00:00", 70, utm_source="meta_ads", utm_campaign="q")],
        ad_campaigns=[{"campaign_id": c, "name": c, "utm_campaign": "q"} for c in ("m1", "m2")],
        ad_insights=[{"date_day": "2026-02-01", "campaign_id": c, "spend": 7} for c in ("m1", "m2")],
    )
    got = rows(m["fct_marketing_performance"], "campaign_id", "last_touch_revenue", "last_touch_roas")
    assert got == [("m1", D("70.00"), 10.0), ("m2", D("70.00"), 10.0)]


def test_second_ad_platform_is_stacked(spark):
    m = models(
        spark,
        ad_campaigns=[{"campaign_id": "m1", "name": "Meta one"}],
        ad_insights=[{"date_day": "2026-02-01", "campaign_id": "m1", "spend": 7, "impressions": 1}],
    )
    other = m["stg_ad_insights"].withColumn("spend", F.lit(D("3.00")))
    m.extra_spend = ((other, "google_ads"),)
    got = rows(m["int_unified_spend"], "platform", "campaign_id", "campaign_name", "spend")
    # Campaign names are only known for the first platform.
    assert got == [("google_ads", "m1", "m1", D("3.00")), ("meta_ads", "m1", "Meta one", D("7.00"))]
    assert rows(m["fct_blended_roas"].where("total_spend > 0"), "total_spend") == [(D("10.00"),)]


def _event(event_id, when, name, source="google", session="s1", value=None):
    return {
        "event_id": event_id, "event_timestamp": when, "event_name": name, "user_pseudo_id": "u1",
        "session_id": session, "source": source, "medium": "cpc", "campaign": "q",
        "ga_session_number": 1, "event_value": value,
    }


def test_session_takes_the_first_event(spark):
    m = models(
        spark,
        web_events=[
            _event("e2", "2026-02-01 10:00:00", "page_view", "late"),
            _event("e1", "2026-02-01 10:00:00", "page_view", "first"),
            _event("e3", "2026-02-01 10:05:00", "purchase", "late", value=20),
            _event("e4", "2026-02-01 10:06:00", "purchase", "late"),
        ],
    )
    got = rows(
        m["stg_web_sessions"],
        "session_source", "had_purchase", "had_view_item", "page_view_count", "purchase_value",
    )
    assert got == [("first", 1, 0, 2, D("20.00"))]


def test_sessions_are_linked_to_matching_orders_in_one_row(spark):
    tags = {"utm_source": "google", "utm_medium": "cpc", "utm_campaign": "q"}
    m = models(
        spark,
        web_events=[
            _event("e1", "2026-02-01 10:00:00", "purchase"),
            _event("e2", "2026-02-01 10:00:00", "page_view", session="s2"),
            _event("e3", "2026-02-03 10:00:00", "purchase", session="s3"),
        ],
        orders=[
            order("o1", "c1", "2026-02-01 11:00:00", **tags),
            order("o2", "c2", "2026-02-01 12:00:00", **tags),
        ],
    )
    got = rows(m["int_sessions_attributed"], "session_id", "order_id", "customer_id", "linked_orders", "linked_subtotal")
    none = (None, None, 0, D("0.00"))
    assert got == [("s1", "o1", "c1", 2, D("200.00")), ("s2", *none), ("s3", *none)]


def test_rows_without_a_time_are_not_first(spark):
    m = models(
        spark,
        orders=[
            {**order("o1", "c1", "2026-02-01 10:00:00", utm_source="late"), "created_at": None},
            order("o2", "c1", "2026-03-01 10:00:00", utm_source="first"),
        ],
        web_events=[
            {"event_id": "e1", "event_name": "page_view", "user_pseudo_id": "u", "session_id": "s", "source": "no time"},
            {"event_id": "e2", "event_name": "page_view", "user_pseudo_id": "u", "session_id": "s", "source": "timed",
             "event_timestamp": "2026-02-01 00:00:00"},
        ],
    )
    assert rows(m["int_customer_order_history"], "acquisition_source", "first_order_date") == [("first", date(2026, 3, 1))]
    assert rows(m["fct_attribution_first_touch"], "order_id", "first_touch_source") == [("o1", "first"), ("o2", "first")]
    assert rows(m["stg_web_sessions"], "session_source") == [("timed",)]


def test_cohort_across_a_month_edge(spark):
    m = models(
        spark,
        orders=[
            order("o1", "c1", "2026-01-31 23:00:00", 10),
            order("o2", "c1", "2026-02-01 01:00:00", 20),
            order("o3", "c2", "2026-01-02 01:00:00", 30),
        ],
    )
    got = rows(
        m["customer_cohort_retention"],
        "cohort_month", "months_since_acquisition", "cohort_customers", "active_customers",
        "cohort_revenue", "retention_rate",
    )
    january = date(2026, 1, 1)
    assert got == [(january, 0, 2, 2, D("40.00"), 1.0), (january, 1, 2, 1, D("20.00"), 0.5)]


def test_ltv_windows_are_inclusive(spark):
    first = date(2026, 1, 1)
    days = [0, 30, 31, 60, 90, 180, 365, 366]
    m = models(
        spark,
        orders=[
            order(f"o{d}", "c1", f"{date.fromordinal(first.toordinal() + d)} 00:00:00", 1) for d in days
        ],
    )
    got = rows(
        m["customer_ltv"],
        "ltv_revenue_total", *[f"ltv_revenue_{d}d" for d in (30, 60, 90, 180, 365)],
        "ltv_margin_90d", "ltv_margin_365d",
    )
    assert got == [tuple(D(f"{n}.00") for n in (8, 2, 4, 5, 6, 7, 5, 7))]


def test_guarded_divisions(spark):
    m = models(
        spark,
        ad_insights=[
            {"date_day": "2026-02-01", "campaign_id": "m1", "impressions": 0, "clicks": 0, "spend": 0},
            {
                "date_day": "2026-02-02", "campaign_id": "m1", "impressions": 200, "clicks": 4,
                "spend": 8, "reported_conversion_value": 24,
            },
        ],
        products=[
            {"product_id": "p1", "price": 0, "cost": 1},
            {"product_id": "p2", "price": 10, "cost": 4},
            {"product_id": "p3", "price": 10, "cost": None},
        ],
        orders=[order("o1", "c1", "2026-02-02 10:00:00", 0)],
    )
    assert rows(m["stg_ad_insights"], "ctr", "cpm", "cpc", "platform_reported_roas") == [
        (0.0, 0.0, None, 0.0),
        (0.02, 40.0, 2.0, 3.0),
    ]
    assert rows(m["stg_products"], "product_id", "product_margin_pct") == [
        ("p1", None), ("p2", 0.6), ("p3", None),
    ]
    assert rows(m["fct_orders"], "contribution_margin_pct") == [(0.0,)]
    days = m["fct_blended_roas"].where("date_day <= date'2026-02-02' and date_day >= date'2026-02-01'")
    assert rows(days, "date_day", "blended_roas") == [
        (date(2026, 2, 1), None), (date(2026, 2, 2), 0.0),
    ]


def test_costs_and_margins(spark):
    lines = [
        {"order_line_id": "l1", "order_id": "o1", "product_id": "p1", "quantity": 2, "price": 30},
        {"order_line_id": "l2", "order_id": "o1", "product_id": "p2", "quantity": 1, "price": 40,
         "total_discount": 5},
        {"order_line_id": "l3", "order_id": "gone", "product_id": "p1", "quantity": 1, "price": 30},
        {"order_line_id": "l4", "order_id": "o1", "product_id": "unknown", "quantity": 3, "price": 1},
    ]
    m = models(
        spark,
        orders=[order("o1", "c1", "2026-02-02 10:00:00", 100), order("o2", "c1", "2026-02-03 10:00:00", 5)],
        order_lines=lines,
        products=[
            {"product_id": "p1", "price": 30, "cost": 12, "title": "P"},
            {"product_id": "p2", "price": 40, "cost": None, "title": "Q"},
        ],
    )
    got = rows(
        m["fct_orders"], "order_id", "order_cogs", "line_count", "units_ordered", "contribution_margin",
        "contribution_margin_pct",
    )
    assert got == [("o1", D("24.00"), 3, 6, D("76.00"), 0.76), ("o2", D("0.00"), 0, 0, D("5.00"), 1.0)]
    items = rows(
        m["fct_order_items"], "order_line_id", "product_title", "line_cogs", "net_line_revenue",
        "line_gross_margin",
    )
    assert items == [
        ("l1", "P", D("24.00"), D("60.00"), D("36.00")),
        ("l2", "Q", D("0.00"), D("35.00"), D("35.00")),
        ("l4", None, D("0.00"), D("3.00"), D("3.00")),
    ]


def test_unknown_email_event_is_spelled_out(spark):
    m = models(
        spark,
        email_events=[
            {"event_id": "e1", "event_name": "Bounced Email", "campaign_id": "c", "flow_id": "f"},
            {"event_id": "e2", "event_name": "Received SMS", "campaign_id": "", "flow_id": "f"},
            {"event_id": "e3", "event_name": "Placed Order", "event_value": None},
        ],
    )
    got = rows(m["stg_email_events"], "event_id", "event_type", "message_source", "event_value")
    assert got == [
        ("e1", "bounced_email", "campaign", D("0.00")),
        ("e2", "received_sms", "flow", D("0.00")),
        ("e3", "placed_order", "other", D("0.00")),
    ]


def test_payback_without_spend_is_null(spark):
    m = models(
        spark,
        orders=[order("o1", "c1", "2026-01-05 10:00:00", 10), order("o2", "c1", "2026-03-05 10:00:00", 10)],
        ad_insights=[{"date_day": "2026-03-01", "campaign_id": "m1", "spend": 4}],
    )
    got = rows(
        m["cohort_payback_curve"],
        "months_since_acquisition", "cum_contribution_margin", "cohort_cac", "payback_ratio",
    )
    assert got == [(0, D("10.00"), 0.0, None), (2, D("20.00"), 0.0, None)]


def test_totals_agree_between_marts(spark, sf_dir):
    import __spark_entry__ as entrypoint

    m = entrypoint._models(spark, sf_dir)
    orders, lines = m["fct_orders"], m["stg_order_lines"]
    net = orders.agg(F.sum("net_subtotal_after_refunds")).first()[0]
    assert m["fct_attribution_last_touch"].agg(F.sum("attributed_revenue")).first()[0] == net
    assert m["rpt_channel_split"].agg(F.sum("revenue")).first()[0] == net
    known = lines.join(orders.select("order_id"), "order_id", "left_semi")
    line_net = known.agg(F.sum("net_line_revenue")).first()[0]
    assert m["fct_order_items"].agg(F.sum("net_line_revenue")).first()[0] == line_net
    segments = m["rpt_rfm_segments"].agg(F.sum("customers")).first()[0]
    assert segments == m["int_customer_order_history"].count()
    sizes = Counter(r["recency_score"] for r in m["customer_rfm"].collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1
