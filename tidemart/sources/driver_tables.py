"""The raw feeds derived from the supplied star-schema tables.

Those tables carry no ad spend, refunds, UTM fields or sessions, so each feed is a
projection or roll-up of one or two of them. Literal timestamps are zone-less, as the
Parquet columns are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.settings import Settings

# Orders and shipments run from 1995 to 2001.
DRIVER_SETTINGS = Settings(
    start_date=date(1995, 1, 1), end_date=date(2001, 12, 31), as_of=date(2001, 12, 31)
)

# The columns read from each supplied table.
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

_EPOCH = "timestamp_ntz'1994-12-31 00:00:00' as created_at"
_LINE_KEY = (
    "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string),"
    " cast(l_partkey as string), cast(l_suppkey as string), cast(cast(l_shipdate as date) as string))"
)
# Events are moved back so that sessions fall into the years that have orders.
_EVENT_TIME = "ts - interval '8766' day"


def _channel(bucket: str, labels: dict[str, tuple[str, str]], prefix: str) -> list[str]:
    """Source and medium columns chosen by the value of ``bucket``."""
    source = " ".join(f"when {k} then '{v[0]}'" for k, v in labels.items())
    medium = " ".join(f"when {k} then '{v[1]}'" for k, v in labels.items())
    return [
        f"case {bucket} {source} else '' end as {prefix}source",
        f"case {bucket} {medium} else '' end as {prefix}medium",
    ]


_CHANNELS = [("meta_ads", "paid_social"), ("google", "cpc"), ("klaviyo", "email"), ("organic", "referral")]


_ORDER_TOTAL = "cast(o_totalprice as decimal(12,2))"
_LINE_AMOUNT = "cast(l_extendedprice as decimal(12,2))"
_USER_EMAIL = "concat(' User', cast(user_id as string), '@Example.com ') as email"

Reader = Callable[[str], DataFrame]


def orders_feed(orders: DataFrame) -> DataFrame:
    """Also applied to a stream of ``orders`` rows."""
    priorities = ["'1-URGENT'", "'2-HIGH'", "'3-MEDIUM'", "'5-LOW'"]
    return orders.selectExpr(
        "o_orderkey as order_id",
        "o_orderkey as order_number",
        "if(o_orderkey % 97 = 0, null, o_custkey) as customer_id",
        "o_orderdate as created_at",
        "o_orderdate + interval '30' second as processed_at",
        "case o_orderstatus when 'F' then 'paid' when 'O' then 'pending'"
        " else 'partially_refunded' end as financial_status",
        "'fulfilled' as fulfillment_status",
        "'USD' as currency",
        f"{_ORDER_TOTAL} as subtotal_price",
        f"cast({_ORDER_TOTAL} * 0.10 as decimal(12,2)) as total_tax",
        f"cast({_ORDER_TOTAL} * 0.05 as decimal(12,2)) as total_discounts",
        "cast(5.00 as decimal(12,2)) as total_shipping",
        f"cast({_ORDER_TOTAL} * 1.05 + 5.00 as decimal(12,2)) as total_price",
        "if(o_orderkey % 11 = 0, '', 'web') as source_name",
        "'' as referring_site",
        *_channel("o_orderpriority", dict(zip(priorities, _CHANNELS)), "utm_"),
        "if(o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM'),"
        " concat('cmp_', cast(o_orderkey % 3 as string)), '') as utm_campaign",
    )


def _order_lines(read: Reader) -> DataFrame:
    return read("lineitem").selectExpr(
        f"md5({_LINE_KEY}) as order_line_id",
        "l_orderkey as order_id",
        "l_partkey as product_id",
        "concat('SKU-', cast(l_partkey as string)) as sku",
        "concat('Item ', cast(l_partkey as string)) as title",
        "cast(l_quantity as int) as quantity",
        f"cast({_LINE_AMOUNT} * 0.01 as decimal(12,2)) as price",
        f"cast({_LINE_AMOUNT} * cast(l_discount as decimal(4,2)) * 0.01 as decimal(12,2))"
        " as total_discount",
    )


def _refunds(read: Reader) -> DataFrame:
    return (
        read("lineitem")
        .where("l_returnflag = 'R'")
        .selectExpr(
            f"md5(concat('r-', {_LINE_KEY})) as refund_id",
            "l_orderkey as order_id",
            "l_shipdate as created_at",
            f"cast({_LINE_AMOUNT} * 0.10 as decimal(12,2)) as refund_amount",
            "'customer_request' as reason",
        )
    )


def _customers(read: Reader) -> DataFrame:
    return read("customer").selectExpr(
        "c_custkey as customer_id",
        "concat('  ', upper(c_name), '@EXAMPLE.COM ') as email",
        "c_name as first_name",
        "c_mktsegment as last_name",
        "if(c_custkey % 7 = 0, '', concat('+1', cast(c_custkey as string))) as phone",
        "c_nationkey as country_code",
        "c_acctbal >= 0 as accepts_marketing",
        _EPOCH,
        "timestamp_ntz'2001-12-31 00:00:00' as updated_at",
    )


def _countries(read: Reader) -> DataFrame:
    return (
        read("nation")
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr("n_nationkey as country_code", "n_name as country_name", "r_name as region")
    )


def _products(read: Reader) -> DataFrame:
    return read("part").selectExpr(
        "p_partkey as product_id",
        "p_name as title",
        "p_type as product_type",
        "p_brand as vendor",
        "concat('SKU-', cast(p_partkey as string)) as sku",
        "if(p_partkey % 53 = 0, cast(0 as decimal(12,2)), cast(p_retailprice as decimal(12,2))) as price",
        "if(p_partkey % 41 = 0, null,"
        " cast(cast(p_retailprice as decimal(12,2)) * 0.25 as decimal(12,2))) as cost",
        "'USD' as currency",
        "'active' as status",
        _EPOCH,
    )


def _ad_insights(read: Reader) -> DataFrame:
    shipped = read("lineitem").selectExpr(
        "cast(l_shipdate as date) as date_day",
        "concat('mc_', cast(l_suppkey % 3 as string)) as campaign_id",
        "concat('as_', cast(l_suppkey % 6 as string)) as ad_set_id",
        "concat('ad_', cast(l_suppkey % 12 as string)) as ad_id",
        "cast(l_quantity as int) as units",
        "l_linenumber",
        "l_returnflag",
        f"{_LINE_AMOUNT} as amount",
    )
    return shipped.groupBy("date_day", "campaign_id", "ad_set_id", "ad_id").agg(
        (F.sum("units") * 100).alias("impressions"),
        F.expr("sum(if(l_linenumber = 7, 0, units))").alias("clicks"),
        F.expr("cast(sum(amount) * 0.01 as decimal(12,2))").alias("spend"),
        F.expr("sum(if(l_returnflag = 'N', 1, 0))").alias("reported_conversions"),
        F.expr("cast(sum(amount) * 0.03 as decimal(12,2))").alias("reported_conversion_value"),
    )


def _small_ids(read: Reader, modulus: int) -> DataFrame:
    return read("supplier").select((F.col("s_suppkey") % modulus).alias("i")).distinct()


def _ad_campaigns(read: Reader) -> DataFrame:
    return _small_ids(read, 3).selectExpr(
        "concat('mc_', cast(i as string)) as campaign_id",
        "concat('Campaign ', cast(i as string)) as name",
        "'OUTCOME_SALES' as objective",
        "'active' as status",
        "cast(30.00 as decimal(12,2)) as daily_budget",
        "concat('cmp_', cast(i as string)) as utm_campaign",
        _EPOCH,
    )


def _ad_sets(read: Reader) -> DataFrame:
    return _small_ids(read, 6).selectExpr(
        "concat('as_', cast(i as string)) as ad_set_id",
        "concat('mc_', cast(i % 3 as string)) as campaign_id",
        "concat('Set ', cast(i as string)) as name",
        "'OFFSITE_CONVERSIONS' as optimization_goal",
        "'active' as status",
        _EPOCH,
    )


def _ads(read: Reader) -> DataFrame:
    return _small_ids(read, 12).selectExpr(
        "concat('ad_', cast(i as string)) as ad_id",
        "concat('as_', cast(i % 6 as string)) as ad_set_id",
        "concat('Ad ', cast(i as string)) as name",
        "'video' as creative_type",
        "'active' as status",
        _EPOCH,
    )


def _with_property(events: DataFrame) -> DataFrame:
    return events.withColumn(
        "k", F.expr("""cast(replace(replace(props, '{"k": ', ''), '}', '') as int)""")
    )


def web_events_feed(events: DataFrame) -> DataFrame:
    """Also applied to a stream of ``events`` rows."""
    return _with_property(events).selectExpr(
        "event_id",
        "case event_type when 'view' then 'view_item' when 'click' then 'add_to_cart'"
        " when 'signup' then 'begin_checkout' when 'purchase' then 'purchase'"
        " else 'page_view' end as event_name",
        f"{_EVENT_TIME} as event_timestamp",
        "cast(user_id as string) as user_pseudo_id",
        "concat(cast(user_id as string), '-', cast(cast(ts as date) as string)) as session_id",
        *_channel("k % 5", dict(zip("0123", _CHANNELS)), ""),
        "if(k % 5 <= 2, concat('cmp_', cast(k % 3 as string)), '') as campaign",
        "concat('https://shop.example.com/', cast(k as string)) as page_location",
        "concat('Page ', cast(k as string)) as page_title",
        "cast(extract(day from ts) as int) as ga_session_number",
        "if(event_type = 'error', null, cast(value as decimal(12,2))) as event_value",
        "if(event_type = 'purchase', k % 4 + 1, null) as items_count",
    )


def _email_events(read: Reader) -> DataFrame:
    return _with_property(read("events")).selectExpr(
        "event_id",
        "user_id as profile_id",
        _USER_EMAIL,
        "case event_type when 'purchase' then 'Placed Order' when 'click' then 'Clicked Email'"
        " when 'view' then 'Opened Email' when 'signup' then 'Subscribed to List'"
        " else 'Bounced Email' end as event_name",
        f"{_EVENT_TIME} as event_at",
        "if(event_type = 'purchase', cast(value as decimal(12,2)), null) as event_value",
        "if(k < 30, concat('camp_', cast(k % 4 as string)), '') as campaign_id",
        "if(k >= 20 and k < 60, concat('flow_', cast(k % 4 as string)), '') as flow_id",
        "concat('msg_', cast(k as string)) as message_id",
        "if(event_type = 'purchase' and k % 2 = 0, cast(event_id as string), '') as attributed_order_id",
    )


def _email_campaigns(read: Reader) -> DataFrame:
    return _small_ids(read, 4).selectExpr(
        "concat('camp_', cast(i as string)) as campaign_id",
        "concat('Email ', cast(i as string)) as name",
        "concat('Subject ', cast(i as string)) as subject_line",
        "if(i = 3, 'sms', 'email') as channel",
        "timestamp_ntz'2000-01-01 09:00:00' as sent_at",
        "cast(i * 5 as int) as recipient_count",
    )


def _email_flows(read: Reader) -> DataFrame:
    return _small_ids(read, 4).selectExpr(
        "concat('flow_', cast(i as string)) as flow_id",
        "concat('Flow ', cast(i as string)) as name",
        "'placed_order' as trigger_type",
        "if(i = 0, 'draft', 'active') as status",
    )


def _email_profiles(read: Reader) -> DataFrame:
    first_seen = read("events").groupBy("user_id").agg(F.min("ts").alias("ts"))
    return first_seen.selectExpr(
        "user_id as profile_id",
        _USER_EMAIL,
        f"{_EVENT_TIME} as created_at",
        "user_id % 3 > 0 as accepts_marketing",
        "cast(user_id % 25 as int) as country_code",
    )


FEEDS: dict[str, Callable[[Reader], DataFrame]] = {
    "orders": lambda read: orders_feed(read("orders")),
    "order_lines": _order_lines,
    "customers": _customers,
    "products": _products,
    "refunds": _refunds,
    "email_events": _email_events,
    "email_campaigns": _email_campaigns,
    "email_flows": _email_flows,
    "email_profiles": _email_profiles,
    "ad_campaigns": _ad_campaigns,
    "ad_sets": _ad_sets,
    "ads": _ads,
    "ad_insights": _ad_insights,
    "web_events": lambda read: web_events_feed(read("events")),
    "countries": _countries,
}


class CommerceFeeds(Mapping[str, DataFrame]):
    """The raw feeds over one folder of supplied tables; a feed is only planned when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._planned: dict[str, DataFrame] = {}

    def base(self, table: str) -> DataFrame:
        return self.spark.read.schema(BASE_SCHEMAS[table]).parquet(f"{self.sf_dir}/{table}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = FEEDS[name](self.base)
        return self._planned[name]

    def __iter__(self) -> Iterator[str]:
        return iter(FEEDS)

    def __len__(self) -> int:
        return len(FEEDS)
