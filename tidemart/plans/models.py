"""The model graph: every table by name, built lazily from the raw feeds or a stored copy."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemart.functions.calendar import date_spine
from tidemart.plans import analyses, core, customer, intermediate, marketing, reports, staging
from tidemart.settings import Settings


class Models:
    """Named models over a set of raw feeds.

    ``models["fct_orders"]`` returns a lazy DataFrame. Models found in ``stored`` are read
    from there instead of being derived, which is how reports run over built marts.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        settings: Settings | None = None,
        stored: Mapping[str, DataFrame] | None = None,
        extra_spend: Sequence[tuple[DataFrame, str]] = (),
    ) -> None:
        self.spark = spark
        self.raw = raw
        self.settings = settings or Settings()
        self.stored = dict(stored or {})
        # Staged insights of further ad platforms with their labels.
        self.extra_spend = tuple(extra_spend)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.stored:
            return self.stored[name]
        if name not in self._built:
            if name.startswith("raw_"):
                self._built[name] = self.raw[name.removeprefix("raw_")]
            else:
                self._built[name] = MODELS[name](self)
        return self._built[name]

    @property
    def derived_net_orders(self) -> DataFrame:
        """Orders net of refunds, always from the feeds."""
        return self._once(
            "net_orders", lambda: intermediate.order_net(self["stg_orders"], self["stg_refunds"])
        )

    @property
    def net_orders(self) -> DataFrame:
        """Orders net of refunds, without customer attributes."""
        if "fct_orders" in self.stored:
            return self.stored["fct_orders"]
        return self.derived_net_orders

    @property
    def joined_orders(self) -> DataFrame:
        """Orders net of refunds, with customer attributes."""
        if "fct_orders" in self.stored:
            return self.stored["fct_orders"]
        return intermediate.with_customer(self.derived_net_orders, self["stg_customers"])

    @property
    def economics(self) -> DataFrame:
        """Net orders with cost of goods and margin, without customer attributes."""
        if "fct_orders" in self.stored:
            return self.stored["fct_orders"]
        return self._once(
            "economics",
            lambda: core.order_economics(
                self.derived_net_orders, self["stg_order_lines"], self["stg_products"]
            ),
        )

    @property
    def member_orders(self) -> DataFrame:
        """The cheapest table that has customer, time and UTM fields per order."""
        if "fct_orders" in self.stored:
            return self.stored["fct_orders"]
        return self["stg_orders"]

    @property
    def spend_platforms(self) -> list[tuple[DataFrame, str]]:
        return [(self["stg_ad_insights"], staging.ADS_PLATFORM), *self.extra_spend]

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = f"_{name}"
        if key not in self._built:
            self._built[key] = build()
        return self._built[key]


STAGING: dict[str, Callable[[Models], DataFrame]] = {
    "stg_orders": lambda m: staging.orders(m["raw_orders"]),
    "stg_order_lines": lambda m: staging.order_lines(m["raw_order_lines"]),
    "stg_customers": lambda m: staging.customers(m["raw_customers"]),
    "stg_products": lambda m: staging.products(m["raw_products"]),
    "stg_refunds": lambda m: staging.refunds(m["raw_refunds"]),
    "stg_email_events": lambda m: staging.email_events(m["raw_email_events"]),
    "stg_email_campaigns": lambda m: staging.email_campaigns(m["raw_email_campaigns"]),
    "stg_email_flows": lambda m: staging.email_flows(m["raw_email_flows"]),
    "stg_email_profiles": lambda m: staging.email_profiles(m["raw_email_profiles"]),
    "stg_ad_campaigns": lambda m: staging.ad_campaigns(m["raw_ad_campaigns"]),
    "stg_ad_sets": lambda m: staging.ad_sets(m["raw_ad_sets"]),
    "stg_ads": lambda m: staging.ads(m["raw_ads"]),
    "stg_ad_insights": lambda m: staging.ad_insights(m["raw_ad_insights"]),
    "stg_web_events": lambda m: staging.web_events(m["raw_web_events"]),
    "stg_web_sessions": lambda m: staging.web_sessions(m["stg_web_events"]),
}

INTERMEDIATE: dict[str, Callable[[Models], DataFrame]] = {
    "int_orders_joined": lambda m: intermediate.orders_joined(m.joined_orders),
    "int_customer_order_history": lambda m: intermediate.customer_order_history(m.net_orders),
    "int_unified_spend": lambda m: intermediate.unified_spend(m.spend_platforms, m["stg_ad_campaigns"]),
    "int_sessions_attributed": lambda m: intermediate.sessions_attributed(
        m["stg_web_sessions"], m.member_orders
    ),
}

MARTS: dict[str, Callable[[Models], DataFrame]] = {
    "fct_orders": lambda m: core.fct_orders(m.economics, m["stg_customers"]),
    "dim_dates": lambda m: core.dim_dates(
        date_spine(m.spark, m.settings.start_date, m.settings.end_date)
    ),
    "dim_products": lambda m: core.dim_products(m["stg_products"]),
    "dim_customers": lambda m: core.dim_customers(
        m["stg_customers"], m["int_customer_order_history"], m["raw_countries"]
    ),
    "fct_order_items": lambda m: core.fct_order_items(
        m["stg_order_lines"], m.member_orders, m["stg_products"]
    ),
    "fct_marketing_performance": lambda m: marketing.fct_marketing_performance(
        m["int_unified_spend"], m["stg_ad_campaigns"], m.economics, m.member_orders
    ),
    "fct_attribution_first_touch": lambda m: marketing.fct_attribution_first_touch(
        m.member_orders, m.economics
    ),
    "fct_attribution_last_touch": lambda m: marketing.fct_attribution_last_touch(m.economics),
    "fct_blended_roas": lambda m: marketing.fct_blended_roas(
        m["dim_dates"],
        m.economics,
        m["int_unified_spend"],
        m.settings.start_date,
        m.settings.end_date,
    ),
    "customer_ltv": lambda m: customer.customer_ltv(m.economics),
    "customer_cohort_retention": lambda m: customer.customer_cohort_retention(m.economics),
    "customer_rfm": lambda m: customer.customer_rfm(
        m["int_customer_order_history"], m.settings.as_of
    ),
}

ANALYSES: dict[str, Callable[[Models], DataFrame]] = {
    "monthly_business_review": lambda m: analyses.monthly_business_review(
        m["dim_dates"], m.economics, m["int_unified_spend"]
    ),
    "cohort_payback_curve": lambda m: analyses.cohort_payback_curve(
        m.economics, m["int_unified_spend"]
    ),
}

# Reports that show no customer attribute read ``economics`` in place of ``fct_orders``.
REPORTS: dict[str, Callable[[Models], DataFrame]] = {
    "rpt_headline_kpis": lambda m: reports.headline_kpis(m.economics),
    "rpt_total_spend": lambda m: reports.total_spend(m["fct_marketing_performance"]),
    "rpt_blended_totals": lambda m: reports.blended_totals(m["fct_blended_roas"]),
    "rpt_daily_revenue_spend": lambda m: reports.daily_revenue_spend(m["fct_blended_roas"]),
    "rpt_channel_split": lambda m: reports.channel_split(m["fct_attribution_last_touch"]),
    "rpt_marketing_totals": lambda m: reports.marketing_totals(m["fct_marketing_performance"]),
    "rpt_blended_single": lambda m: reports.blended_single(m["fct_blended_roas"]),
    "rpt_daily_roas": lambda m: reports.daily_roas(m["fct_blended_roas"]),
    "rpt_by_campaign": lambda m: reports.by_campaign(m["fct_marketing_performance"]),
    "rpt_monthly_spend": lambda m: reports.monthly_campaign_spend(m["fct_marketing_performance"]),
    "rpt_customer_kpis": lambda m: reports.customer_kpis(m["dim_customers"]),
    "rpt_cohort_grid": lambda m: reports.cohort_grid(m["customer_cohort_retention"]),
    "rpt_ltv_by_channel": lambda m: reports.ltv_by_channel(m["dim_customers"], m["customer_ltv"]),
    "rpt_rfm_segments": lambda m: reports.rfm_segments(m["customer_rfm"]),
    "rpt_order_kpis": lambda m: reports.order_kpis(m.economics),
    "rpt_daily_orders": lambda m: reports.daily_orders(m.economics),
    "rpt_product_revenue": lambda m: reports.product_revenue(m["fct_order_items"], m["dim_products"]),
    "rpt_product_margin": lambda m: reports.product_margin(m["fct_order_items"]),
    "rpt_daily_long": lambda m: reports.daily_long(m["fct_blended_roas"]),
    "rpt_roas_long": lambda m: reports.roas_long(m["fct_blended_roas"]),
    "rpt_ltv_long": lambda m: reports.ltv_long(m["dim_customers"], m["customer_ltv"]),
    "rpt_margin_long": lambda m: reports.margin_long(m["fct_order_items"]),
}

MODELS = {**STAGING, **INTERMEDIATE, **MARTS, **ANALYSES, **REPORTS}
