"""What the incremental and streaming loads must leave behind, as SQL."""

from __future__ import annotations

from tidemart.oracle.documentation import DOCUMENTATION_SQL

LOAD_SQL: dict[str, str] = {
    # Orders processed from the earlier run's newest order on are recomputed in full; older
    # ones keep the refunds known then. 1999-01-01 is the moment of the earlier run.
    "fct_orders_incremental": """
        with early_refunds as (
            select order_id, sum(refund_amount) as amount, count(*) as refunds
            from stg_refunds where refunded_at < timestamp '1999-01-01 00:00:00' group by order_id
        ), newest as (
            select max(processed_at) as processed_at from fct_orders
            where processed_at < timestamp '1999-01-01 00:00:00'
        ), kept as (
            select f.* replace (
                cast(coalesce(r.amount, 0) as decimal(18,2)) as refund_amount,
                coalesce(r.refunds, 0) as refund_count,
                cast(f.order_subtotal - coalesce(r.amount, 0) as decimal(18,2)) as net_subtotal_after_refunds,
                cast(f.order_subtotal - coalesce(r.amount, 0) - f.order_cogs as decimal(18,2)) as contribution_margin,
                case when f.order_subtotal - coalesce(r.amount, 0) > 0
                    then cast(f.order_subtotal - coalesce(r.amount, 0) - f.order_cogs as double)
                        / cast(f.order_subtotal - coalesce(r.amount, 0) as double)
                    else 0.0e0 end as contribution_margin_pct)
            from fct_orders f left join early_refunds r on r.order_id = f.order_id
            where f.processed_at < (select processed_at from newest)
        )
        select * from kept
        union all select * from fct_orders where processed_at >= (select processed_at from newest)
    """,
    "fct_orders_stream": "select * from fct_orders",
    # Two columns came with the later load only.
    "fct_orders_grown": """
        select * replace (
            case when processed_at >= timestamp '1999-01-01 00:00:00' then source_name end as source_name,
            case when processed_at >= timestamp '1999-01-01 00:00:00' then referring_site end as referring_site)
        from fct_orders
    """,
    # The month before the loaded one still has the orders of 1997-03 that were moved from it.
    "dq_load": """
        select 'fct_orders' as table_name, 'order_id' as column_name, count(*) as failures,
            case when count(*) = 0 then 'pass' else 'fail' end as status
        from fct_orders where date_trunc('month', order_date) = date '1997-03-01'
        union all
        select 'fct_orders', 'customer_id', count(*), case when count(*) = 0 then 'pass' else 'fail' end
        from fct_orders where date_trunc('month', order_date) in (date '1997-03-01', date '1997-04-01')
            and customer_id is not null and customer_id not in (select customer_id from dim_customers)
    """,
    # Who is in a cell that has both sessions and orders, and how many pairs there are in all.
    "_linked": """
        select s.*, o.order_id as linked_order, o.customer_id as linked_customer
        from stg_web_sessions s join stg_orders o
          on s.session_date = o.order_date and s.session_source = o.utm_source
         and s.session_medium = o.utm_medium and s.session_campaign = o.utm_campaign
        where s.had_purchase = 1
    """,
    "session_order_members": """
        select distinct session_date, session_source, session_medium, session_campaign,
            user_pseudo_id, session_id, null as order_id, null as customer_id from _linked
        union all
        select distinct session_date, session_source, session_medium, session_campaign,
            null, null, linked_order, linked_customer from _linked
    """,
    "session_order_links": """
        select session_date, session_source, session_medium, session_campaign,
            count(distinct (user_pseudo_id, session_id)) as sessions, count(distinct linked_order) as orders,
            count(*) as links
        from _linked group by all
    """,
    "unified_spend_two_platforms": """
        select * from int_unified_spend
        union all
        select date_day, 'search_ads', campaign_id, campaign_id, cast(sum(impressions) as bigint),
            cast(sum(clicks * 2) as bigint), cast(sum(spend * 2) as decimal(28,2)),
            cast(sum(reported_conversions) as bigint), cast(sum(reported_conversion_value) as decimal(28,2))
        from stg_ad_insights where clicks % 3 = 0 group by date_day, campaign_id
    """,
    "orders_to_load": """
        select * from stg_orders where processed_at >= (
            select coalesce(max(processed_at), timestamp '1900-01-01 00:00:00') from fct_orders
            where processed_at < timestamp '1999-01-01 00:00:00')
    """,
    **{
        f"view_{name}": f"select * from {name}"
        for name in ("stg_orders", "stg_customers", "stg_email_events", "stg_ad_insights", "stg_web_sessions")
    },
    "catalog_documentation": DOCUMENTATION_SQL,
    "catalog_by_campaign": "select * from rpt_by_campaign",
    "cached_by_campaign": "select * from rpt_by_campaign",
    "csv_orders": """
        select o.order_date, o.financial_status, count(*) as orders, cast(sum(l.lines) as bigint) as lines,
            cast(sum(o.order_total) as decimal(38,2)) as order_total, cast(sum(l.revenue) as decimal(38,2)) as revenue
        from stg_orders o left join (
            select order_id, count(*) as lines, sum(net_line_revenue) as revenue
            from stg_order_lines group by order_id) l on l.order_id = o.order_id
        group by o.order_date, o.financial_status
    """,
    "typed_order_lines": """
        select cast(order_line_id as varchar) as order_line_id, cast(order_id as varchar) as order_id,
            cast(product_id as varchar) as product_id, sku, title, cast(quantity as int) as quantity,
            cast(price as decimal(12,2)) as price, cast(total_discount as decimal(12,2)) as total_discount
        from src_order_lines
    """,
    "built_marketing_performance": "select * from fct_marketing_performance",
    "built_by_campaign": "select * from rpt_by_campaign",
    "order_minor_units": """
        select order_id, cast(order_total as decimal(20,4)) as order_total,
            cast(refund_amount as decimal(20,4)) as refund_amount
        from int_orders_joined
    """,
    # The days from the first order to the last.
    "order_dates": """
        select d as date_day, cast(year(d) as int) as year, cast(month(d) as int) as month,
            cast(day(d) as int) as day_of_month, cast(dayofweek(d) as int) as day_of_week,
            cast(date_trunc('week', d) as date) as week_start_date,
            cast(date_trunc('month', d) as date) as month_start_date,
            cast(date_trunc('quarter', d) as date) as quarter_start_date,
            cast(date_trunc('year', d) as date) as year_start_date
        from (select cast(unnest(range(min(order_date), max(order_date) + 1, interval 1 day)) as date) as d
              from stg_orders)
    """,
    "web_sessions_stream": "select * from stg_web_sessions",
}
