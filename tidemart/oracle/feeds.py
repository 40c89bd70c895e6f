"""The raw feeds as SQL over the supplied tables, for the comparison engine."""

from __future__ import annotations

FEED_SQL: dict[str, str] = {
    "src_customers": """
        select c_custkey as customer_id, '  ' || upper(c_name) || '@EXAMPLE.COM ' as email, c_name as
        first_name, c_mktsegment as last_name, case when c_custkey % 7 = 0 then '' else '+1' ||
        cast(c_custkey as string) end as phone, c_nationkey as country_code, c_acctbal >= 0 as
        accepts_marketing, cast('1994-12-31 00:00:00' as timestamp) as created_at,
        cast('2001-12-31 00:00:00' as timestamp) as updated_at from customer
    """,
    "src_countries": """
        select n_nationkey as country_code, n_name as country_name, r_name as region from nation join
        region on n_regionkey = r_regionkey
    """,
    "src_products": """
        select p_partkey as product_id, p_name as title, p_type as product_type, p_brand as vendor, 'SKU-'
        || cast(p_partkey as string) as sku, case when p_partkey % 53 = 0 then cast(0 as decimal(12,2))
        else cast(p_retailprice as decimal(12,2)) end as price, case when p_partkey % 41 = 0 then
        cast(null as decimal(12,2)) else cast(cast(p_retailprice as decimal(12,2)) * 0.25 as
        decimal(12,2)) end as cost, 'USD' as currency, 'active' as status, cast('1994-12-31 00:00:00' as
        timestamp) as created_at from part
    """,
    "src_orders": """
        select o_orderkey as order_id, o_orderkey as order_number, case when o_orderkey % 97 = 0 then null
        else o_custkey end as customer_id, o_orderdate as created_at, o_orderdate + interval '30' second
        as processed_at, case o_orderstatus when 'F' then 'paid' when 'O' then 'pending' else
        'partially_refunded' end as financial_status, 'fulfilled' as fulfillment_status, 'USD' as
        currency, cast(o_totalprice as decimal(12,2)) as subtotal_price, cast(cast(o_totalprice as
        decimal(12,2)) * 0.10 as decimal(12,2)) as total_tax, cast(cast(o_totalprice as decimal(12,2)) *
        0.05 as decimal(12,2)) as total_discounts, cast(5.00 as decimal(12,2)) as total_shipping,
        cast(cast(o_totalprice as decimal(12,2)) * 1.05 + 5.00 as decimal(12,2)) as total_price, case when
        o_orderkey % 11 = 0 then '' else 'web' end as source_name, '' as referring_site, case
        o_orderpriority when '1-URGENT' then 'meta_ads' when '2-HIGH' then 'google' when '3-MEDIUM' then
        'klaviyo' when '5-LOW' then 'organic' else '' end as utm_source, case o_orderpriority when
        '1-URGENT' then 'paid_social' when '2-HIGH' then 'cpc' when '3-MEDIUM' then 'email' when '5-LOW'
        then 'referral' else '' end as utm_medium, case when o_orderpriority in
        ('1-URGENT','2-HIGH','3-MEDIUM') then 'cmp_' || cast(o_orderkey % 3 as string) else '' end as
        utm_campaign from orders
    """,
    "src_order_lines": """
        select md5(cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' ||
        cast(l_partkey as string) || '-' || cast(l_suppkey as string) || '-' || cast(cast(l_shipdate as
        date) as string)) as order_line_id, l_orderkey as order_id, l_partkey as product_id, 'SKU-' ||
        cast(l_partkey as string) as sku, 'Item ' || cast(l_partkey as string) as title, cast(l_quantity
        as int) as quantity, cast(cast(l_extendedprice as decimal(12,2)) * 0.01 as decimal(12,2)) as
        price, cast(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)) * 0.01 as
        decimal(12,2)) as total_discount from lineitem
    """,
    "src_refunds": """
        select md5('r-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' ||
        cast(l_partkey as string) || '-' || cast(l_suppkey as string) || '-' || cast(cast(l_shipdate as
        date) as string)) as refund_id, l_orderkey as order_id, l_shipdate as created_at,
        cast(cast(l_extendedprice as decimal(12,2)) * 0.10 as decimal(12,2)) as refund_amount,
        'customer_request' as reason from lineitem where l_returnflag = 'R'
    """,
    "src_ad_campaigns": """
        select 'mc_' || cast(i as string) as campaign_id, 'Campaign ' || cast(i as string) as name,
        'OUTCOME_SALES' as objective, 'active' as status, cast(30.00 as decimal(12,2)) as daily_budget,
        'cmp_' || cast(i as string) as utm_campaign, cast('1994-12-31 00:00:00' as timestamp) as
        created_at from (select distinct s_suppkey % 3 as i from supplier) t
    """,
    "src_ad_insights": """
        select cast(l_shipdate as date) as date_day, 'mc_' || cast(l_suppkey % 3 as string) as
        campaign_id, 'as_' || cast(l_suppkey % 6 as string) as ad_set_id, 'ad_' || cast(l_suppkey % 12 as
        string) as ad_id, cast(sum(cast(l_quantity as int)) as bigint) * 100 as impressions, cast(sum(case
        when l_linenumber = 7 then 0 else cast(l_quantity as int) end) as bigint) as clicks,
        cast(sum(cast(l_extendedprice as decimal(12,2))) * 0.01 as decimal(12,2)) as spend, cast(sum(case
        when l_returnflag = 'N' then 1 else 0 end) as bigint) as reported_conversions,
        cast(sum(cast(l_extendedprice as decimal(12,2))) * 0.03 as decimal(12,2)) as
        reported_conversion_value from lineitem group by 1, 2, 3, 4
    """,
    "src_web_events": """
        select event_id, case event_type when 'view' then 'view_item' when 'click' then 'add_to_cart' when
        'signup' then 'begin_checkout' when 'purchase' then 'purchase' else 'page_view' end as event_name,
        ts - interval '8766' day as event_timestamp, cast(user_id as string) as user_pseudo_id,
        cast(user_id as string) || '-' || cast(cast(ts as date) as string) as session_id, case k % 5 when
        0 then 'meta_ads' when 1 then 'google' when 2 then 'klaviyo' when 3 then 'organic' else '' end as
        source, case k % 5 when 0 then 'paid_social' when 1 then 'cpc' when 2 then 'email' when 3 then
        'referral' else '' end as medium, case when k % 5 <= 2 then 'cmp_' || cast(k % 3 as string) else
        '' end as campaign, 'https://shop.example.com/' || cast(k as string) as page_location, 'Page ' ||
        cast(k as string) as page_title, cast(extract(day from ts) as int) as ga_session_number, case when
        event_type = 'error' then null else cast(value as decimal(12,2)) end as event_value, case when
        event_type = 'purchase' then k % 4 + 1 else null end as items_count from (select *,
        cast(replace(replace(props, '{"k": ', ''), '}', '') as int) as k from events) e
    """,
    "src_email_events": """
        select event_id, user_id as profile_id, ' User' || cast(user_id as string) || '@Example.com ' as
        email, case event_type when 'purchase' then 'Placed Order' when 'click' then 'Clicked Email' when
        'view' then 'Opened Email' when 'signup' then 'Subscribed to List' else 'Bounced Email' end as
        event_name, ts - interval '8766' day as event_at, case when event_type = 'purchase' then
        cast(value as decimal(12,2)) else null end as event_value, case when k < 30 then 'camp_' || cast(k
        % 4 as string) else '' end as campaign_id, case when k >= 20 and k < 60 then 'flow_' || cast(k % 4
        as string) else '' end as flow_id, 'msg_' || cast(k as string) as message_id, case when event_type
        = 'purchase' and k % 2 = 0 then cast(event_id as string) else '' end as attributed_order_id from
        (select *, cast(replace(replace(props, '{"k": ', ''), '}', '') as int) as k from events) e
    """,
    "src_ad_sets": """
        select 'as_' || cast(i as string) as ad_set_id, 'mc_' || cast(i % 3 as string) as campaign_id,
        'Set ' || cast(i as string) as name, 'OFFSITE_CONVERSIONS' as optimization_goal, 'active' as
        status, cast('1994-12-31 00:00:00' as timestamp) as created_at from (select distinct s_suppkey % 6
        as i from supplier) t
    """,
    "src_ads": """
        select 'ad_' || cast(i as string) as ad_id, 'as_' || cast(i % 6 as string) as ad_set_id, 'Ad ' ||
        cast(i as string) as name, 'video' as creative_type, 'active' as status,
        cast('1994-12-31 00:00:00' as timestamp) as created_at from (select distinct s_suppkey % 12 as i
        from supplier) t
    """,
    "src_email_campaigns": """
        select 'camp_' || cast(i as string) as campaign_id, 'Email ' || cast(i as string) as name,
        'Subject ' || cast(i as string) as subject_line, case when i = 3 then 'sms' else 'email' end as
        channel, cast('2000-01-01 09:00:00' as timestamp) as sent_at, cast(i * 5 as int) as
        recipient_count from (select distinct s_suppkey % 4 as i from supplier) t
    """,
    "src_email_flows": """
        select 'flow_' || cast(i as string) as flow_id, 'Flow ' || cast(i as string) as name,
        'placed_order' as trigger_type, case when i = 0 then 'draft' else 'active' end as status from
        (select distinct s_suppkey % 4 as i from supplier) t
    """,
    "src_email_profiles": """
        select user_id as profile_id, ' User' || cast(user_id as string) || '@Example.com ' as email,
        min(ts) - interval '8766' day as created_at, user_id % 3 > 0 as accepts_marketing, cast(user_id %
        25 as int) as country_code from events group by user_id
    """,
}
