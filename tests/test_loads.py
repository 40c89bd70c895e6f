"""Storage, incremental load and streams."""

import uuid
from decimal import Decimal

import pytest
from fixtures import feed, models, order, rows
from parity import kind
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.operators import upsert
from tidemart.plans import intermediate, staging, warehouse
from tidemart.plans.core import FCT_ORDERS_COLUMNS
from tidemart.plans.incremental import order_rows, orders_beyond, refresh_orders, stored_orders
from tidemart.plans.documentation import documentation_of
from tidemart.plans.models import MARTS, REPORTS, STAGING, Models
from tidemart.plans.views import create_permanent_views
from tidemart.session import scratch_schema
from tidemart.sources.driver_tables import DRIVER_SETTINGS, CommerceFeeds
from tidemart.sources.raw import (
    declared,
    read_catalog_feeds,
    read_csv_feeds,
    read_csv_leniently,
    read_parquet_feeds,
    write_catalog_feeds,
    write_csv_feeds,
    write_monthly_feeds,
    write_raw_tables,
)
from tidemart.sources.schemas import RAW_SCHEMAS, RAW_TABLE_GROUP
from tidemart.streaming import sessions
from tidemart.streaming.orders import apply_order_changes, order_stream
from tidemart.streaming.sessions import (
    compact_sessions,
    read_parts,
    session_parts,
    session_stream,
    sessions_from_parts,
)


def refund(order_id, when, amount=10):
    return {"refund_id": f"r-{order_id}-{when}", "order_id": order_id, "created_at": when, "refund_amount": amount}


def test_csv_feeds_round_trip(spark, tmp_path):
    tables = {
        "orders": [order("o1", "c1", "2026-02-01 10:00:00", "12.34", utm_source="x"), order("o2", None, "2026-02-02 10:00:00")],
        "customers": [{"customer_id": "c1", "phone": "+001", "accepts_marketing": True, "created_at": "2026-01-01 00:00:00"}],
        "ad_insights": [{"date_day": "2026-02-01", "campaign_id": "m", "clicks": 3, "spend": "1.50"}],
    }
    for name in RAW_SCHEMAS:
        rows_of = feed(spark, name, tables.get(name, []))
        rows_of.toPandas().to_csv(tmp_path / f"{name}.csv", index=False)
    read = read_csv_feeds(spark, str(tmp_path))
    assert set(read) == set(RAW_SCHEMAS)
    for name, table in read.items():
        assert table.schema == feed(spark, name, []).schema
        assert rows(table) == rows(feed(spark, name, tables.get(name, [])))


def test_csv_fields_with_quotes_and_line_breaks(spark, tmp_path):
    header = ",".join(StructType.fromDDL(RAW_SCHEMAS["products"]).names)
    line = '"p1","A ""big, bold"" sale\nin two lines",,,,1.00,,USD,active,'
    (tmp_path / "products.csv").write_text(f"{header}\n{line}\n")
    (row,) = read_csv_feeds(spark, str(tmp_path), ["products"], line_breaks=["products"])["products"].collect()
    assert row.title == 'A "big, bold" sale\nin two lines'


def test_declared_types_apply_to_parquet_feeds(spark, tmp_path):
    kinds = "refund_id int, order_id int, created_at timestamp_ntz, refund_amount decimal(12,4), reason string"

    def landed(amount):
        rows = spark.createDataFrame([(1, 2, None, Decimal(amount), "r")], kinds)
        rows.write.mode("overwrite").parquet(str(tmp_path / RAW_TABLE_GROUP["refunds"] / "refunds"))
        return read_parquet_feeds(spark, str(tmp_path), ["refunds"])["refunds"]

    assert landed("1.2300").schema == feed(spark, "refunds", []).schema
    assert landed("1.2300").first().refund_amount == Decimal("1.23")
    with pytest.raises(SparkRuntimeException, match="does not fit"):
        landed("1.2345").collect()


def test_parquet_and_catalog_feeds(spark, tmp_path):
    raw = {name: feed(spark, name, []) for name in RAW_SCHEMAS}
    raw["countries"] = feed(spark, "countries", [{"country_code": "US", "region": "NA"}])
    write_raw_tables(raw, str(tmp_path))
    assert rows(read_parquet_feeds(spark, str(tmp_path))["countries"], "country_code") == [("US",)]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {RAW_TABLE_GROUP['countries']}")
    raw["countries"].write.mode("overwrite").saveAsTable("raw_reference.countries")
    assert rows(read_catalog_feeds(spark, ["countries"])["countries"], "country_code") == [("US",)]


def test_build_stores_every_mart_and_reports_agree(spark, sf_dir, tmp_path):
    feeds = CommerceFeeds(spark, sf_dir)
    direct = Models(spark, feeds, DRIVER_SETTINGS)
    built = warehouse.build(direct, str(tmp_path))
    assert set(built.stored) >= set(MARTS)
    for name in MARTS:
        stored = warehouse.read_mart(spark, str(tmp_path), name)
        assert stored.columns == direct[name].columns
        assert [kind(t) for _, t in stored.dtypes] == [kind(t) for _, t in direct[name].dtypes]
        assert rows(stored) == rows(direct[name]), name
    for name in REPORTS:
        assert rows(built[name]) == rows(direct[name]), name
    assert rows(built["int_orders_joined"]) == rows(direct["int_orders_joined"])
    assert set(warehouse.read_marts(spark, str(tmp_path))) == set(warehouse.BI_TABLES)
    warehouse.cache_reports({"rpt_by_campaign": built["rpt_by_campaign"]}, str(tmp_path / "cache"))
    assert spark.read.parquet(str(tmp_path / "cache/rpt_by_campaign")).count() == 3


def test_catalog_build_keeps_names_and_comments(spark, sf_dir):
    built = warehouse.build_catalog(Models(spark, CommerceFeeds(spark, sf_dir), DRIVER_SETTINGS))
    assert spark.table("marts_marketing.fct_blended_roas").count() == 2556
    described = {r["col_name"]: r["comment"] for r in spark.sql("describe marts_core.fct_orders").collect()}
    assert "refunds" in described["net_subtotal_after_refunds"]
    extended = {r["col_name"]: r["data_type"] for r in spark.sql("describe extended marts_marketing.fct_attribution_first_touch").collect()}
    assert "customer's first-order channel" in extended["Comment"]
    email = spark.table("marts_core.dim_customers").schema["email"]
    assert email.metadata.get("contains_pii") is True
    assert built["fct_orders"].columns == list(FCT_ORDERS_COLUMNS)
    warehouse.create_staging_views(built)
    assert spark.table("stg_orders").count() == 1500
    assert spark.table("stg_customers").schema["email"].metadata.get("contains_pii") is True


def test_staging_layer_in_a_schema_of_its_own(spark):
    m = models(spark, orders=[order("o1", "c1", "2026-02-01 10:00:00")])
    built = warehouse.build_catalog(m, staging=True)
    assert spark.table("staging.stg_orders").count() == 1
    assert spark.table("staging.stg_customers").schema["phone"].metadata.get("contains_pii") is True
    assert rows(built["fct_orders"], "order_id") == [("o1",)]


def test_incremental_run_replaces_and_adds(spark, table):
    first = [order("o1", "c1", "2026-02-01 10:00:00"), order("o2", "c1", "2026-03-01 10:00:00")]
    refresh_orders(models(spark, orders=first), table)
    again = [
        first[0],
        {**first[1], "processed_at": "2026-04-02 00:00:00", "financial_status": "partially_refunded"},
        order("o3", "c2", "2026-04-01 10:00:00"),
    ]
    refunds = [refund("o2", "2026-04-02 00:00:00")]
    m = models(spark, orders=again, refunds=refunds)
    refresh_orders(m, table)
    refresh_orders(m, table)
    got = rows(stored_orders(m, table), "order_id", "refund_amount", "has_refund")
    zero = Decimal("0.00")
    assert got == [("o1", zero, False), ("o2", Decimal("10.00"), True), ("o3", zero, False)]
    assert rows(stored_orders(m, table)) == rows(m["fct_orders"])


def test_late_refund_is_behind_the_watermark(spark, table):
    """The refund's order was processed before the watermark, so the plain run misses it."""
    orders = [order("o1", "c1", "2026-02-01 10:00:00"), order("o2", "c1", "2026-03-01 10:00:00")]
    refresh_orders(models(spark, orders=orders), table)
    m = models(spark, orders=orders, refunds=[refund("o1", "2026-03-05 00:00:00")])
    refresh_orders(m, table)
    assert rows(stored_orders(m, table), "order_id", "refund_count") == [("o1", 0), ("o2", 0)]
    refresh_orders(m, table, with_refunded=True)
    assert rows(stored_orders(m, table), "order_id", "refund_count") == [("o1", 1), ("o2", 0)]


def test_order_stream_converges_and_replays(spark, tmp_path, table):
    source = tmp_path / "changes"
    old = order("o1", "c1", "2026-02-01 10:00:00", 100)
    new = {**old, "processed_at": "2026-02-09 00:00:00", "financial_status": "refunded"}
    other = order("o2", "c2", "2026-02-03 10:00:00", 40)
    m = models(spark, orders=[new, other])

    def run(name, changes):
        feed(spark, "orders", changes).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(RAW_SCHEMAS["orders"]).parquet(str(source))
        order_stream(m, stream, table, str(tmp_path / "progress")).awaitTermination()

    run("first", [new, old])
    run("late", [old, other])
    expected = rows(m["fct_orders"])
    assert rows(stored_orders(m, table)) == expected
    apply_order_changes(m, feed(spark, "orders", [old, other]), table)
    assert rows(stored_orders(m, table)) == expected


def _event(i, when, name, session, source="s"):
    return {
        "event_id": f"e{i:03d}", "event_timestamp": when, "event_name": name, "user_pseudo_id": "u",
        "session_id": session, "source": source, "medium": "m", "campaign": "c", "ga_session_number": i,
        "event_value": i,
    }


def test_session_stream_equals_the_batch_model(spark, tmp_path):
    source, path = tmp_path / "events", str(tmp_path / "parts")
    batches = [
        [
            _event(2, "2026-02-01 23:50:00", "page_view", "night", "second"),
            _event(3, "2026-02-01 12:00:00", "purchase", "noon"),
        ],
        # Out of order, and across midnight.
        [
            _event(1, "2026-02-01 23:40:00", "view_item", "night", "first"),
            _event(4, "2026-02-02 00:10:00", "purchase", "night", "third"),
        ],
        [_event(5, "2026-02-02 09:00:00", "page_view", "noon")],
        # Weeks late: an earlier event of a session, and a session of its own.
        [
            _event(6, "2026-01-03 09:00:00", "add_to_cart", "noon", "earliest"),
            _event(7, "2026-01-04 09:00:00", "purchase", "old"),
        ],
    ]
    for batch in batches:
        feed(spark, "web_events", batch).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(RAW_SCHEMAS["web_events"]).parquet(str(source))
        staged = staging.web_events(stream)
        session_stream(staged, path, str(tmp_path / "progress")).awaitTermination()
    m = models(spark, web_events=[e for batch in batches for e in batch])
    got = sessions_from_parts(read_parts(spark, path))
    assert got.columns == m["stg_web_sessions"].columns
    assert rows(got) == rows(m["stg_web_sessions"])
    # A batch that is replayed replaces its own partials only.
    again = staging.web_events(feed(spark, "web_events", batches[1]))
    session_parts(again).write.mode("overwrite").parquet(f"{path}/batch-{1:012d}")
    assert rows(sessions_from_parts(read_parts(spark, path))) == rows(m["stg_web_sessions"])


def test_compaction_keeps_every_session(spark, tmp_path, monkeypatch):
    path, events = str(tmp_path / "parts"), []

    def batch(number):
        new = [_event(10 * number + i, f"2026-02-0{1 + i} 10:00:00", "purchase", f"s{i}") for i in range(3)]
        events.extend(new)
        staged = staging.web_events(feed(spark, "web_events", new))
        session_parts(staged).write.parquet(f"{path}/batch-{number:012d}")

    def same():
        m = models(spark, web_events=events)
        return rows(sessions_from_parts(read_parts(spark, path))) == rows(m["stg_web_sessions"])

    assert read_parts(spark, path) is None
    batch(0)
    batch(1)
    with monkeypatch.context() as patched:  # broken off before old batches go
        patched.setattr(sessions.Folder, "remove", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact_sessions(spark, path)
    assert same()
    batch(2)
    assert same()
    compact_sessions(spark, path)
    assert same() and [p.name for p in (tmp_path / "parts").iterdir()] == [f"upto-{2:012d}"]
    compact_sessions(spark, path)
    batch(3)
    assert same()


MOVES = [("2026-02-01 10:00:00", True), (None, True), (None, False)]


@pytest.mark.parametrize(("before", "searched"), MOVES)
def test_order_that_changes_its_month_has_one_row(spark, table, before, searched):
    kept = order("o2", "c1", "2026-02-02 10:00:00")
    now = {**order("o1", "c1", "2026-04-01 10:00:00"), "processed_at": "2026-04-02 00:00:00"}
    then = {**now, "created_at": before, "processed_at": "2026-03-01 00:00:00"}
    m = models(spark, orders=[now, kept])
    options = {} if searched else {"rows_move": False}
    refresh_orders(models(spark, orders=[then, kept]), table, **options)
    refresh_orders(m, table, **options)
    assert rows(stored_orders(m, table)) == rows(m["fct_orders"])
    stream, options = f"{table}_stream", {} if searched else {"dates_change": False}
    for change in (then, kept, now):
        apply_order_changes(m, feed(spark, "orders", [change]), stream, **options)
    assert rows(stored_orders(m, stream)) == rows(m["fct_orders"])


@pytest.mark.parametrize(("landed", "change"), [(None, False), ("2026-02-01", True)])
def test_lines_that_landed_under_another_month_are_read(spark, tmp_path, landed, change):
    m = models(spark, orders=[order("o1", "c1", "2026-04-01 10:00:00")], refunds=[refund("o1", "2026-04-02 00:00:00")])
    month = F.lit(landed).cast("date")
    stored = {t: m.raw[t].withColumn("order_month", month) for t in ("order_lines", "refunds")}
    monthly = Models(spark, {**m.raw, **stored}, m.settings)
    got = order_rows(monthly, monthly["stg_orders"], **({"dates_change": True} if change else {}))
    assert rows(got, "order_id", "refund_count") == [("o1", 1)]
    assert rows(got) == rows(m["fct_orders"])


def test_load_touches_the_months_of_changed_orders_only(spark, tmp_path, table):
    """By default, where dates may change: the lookup finds the old month, the others stay as they are."""
    days = [f"2026-{month:02}-{day:02} 10:00:00" for month in range(1, 7) for day in (3, 9)]
    orders = [order(f"o{i:02}", "c1", day) for i, day in enumerate(days)]
    lines = [{"order_line_id": f"l{i}", "order_id": f"o{i:02}", "quantity": 1} for i in range(len(days))]
    refresh_orders(models(spark, orders=orders, order_lines=lines), table)
    before = upsert._state(spark, table)
    # One order moves from January to June.
    orders[0] = {**orders[0], "created_at": "2026-06-20 10:00:00", "processed_at": "2026-07-01 00:00:00"}
    m = models(spark, orders=orders, order_lines=lines, refunds=[refund("o00", "2026-07-01 00:00:00")])
    write_monthly_feeds(m.raw, str(tmp_path))
    landed = Models(spark, {**m.raw, **read_parquet_feeds(spark, str(tmp_path), ["order_lines", "refunds"])}, m.settings)
    refresh_orders(landed, table)
    after = upsert._state(spark, table)
    rewritten = {v for v in before.holds if before.holds[v] != after.holds.get(v)}
    assert rewritten == {"2026-01-01", "2026-06-01"}
    assert rows(stored_orders(m, table)) == rows(m["fct_orders"])


def test_csv_lines_that_do_not_fit_are_kept_with_their_text(spark, tmp_path):
    header = ",".join(StructType.fromDDL(RAW_SCHEMAS["refunds"]).names)
    good = "r1,o1,2026-02-01 10:00:00,5.00,late"
    bad = ["r2,o2,2026-02-01 10:00:00,much,late", "r3,o3,2026-02-01 10:00:00", f"{good},more"]
    (tmp_path / "refunds.csv").write_text("\n".join([header, good, *bad]) + "\n")
    fitting, others = read_csv_leniently(spark, str(tmp_path / "refunds.csv"), "refunds")
    assert fitting.schema == feed(spark, "refunds", []).schema
    assert rows(fitting, "refund_id") == [("r1",)]
    assert rows(others, "line") == [(line,) for line in sorted(bad)]
    assert others.first()["file"].endswith("refunds.csv")
    assert others.count() == 3 and fitting.count() == 1
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|header"):
        read_csv_feeds(spark, str(tmp_path), ["refunds"])["refunds"].collect()


def test_a_large_csv_is_read_by_several_tasks(spark, tmp_path):
    lines = [{"refund_id": f"r{i}", "order_id": f"o{i}", "reason": "x" * 200} for i in range(500)]
    write_csv_feeds({"refunds": feed(spark, "refunds", lines).coalesce(1)}, str(tmp_path), ["refunds"])
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, 20_000)
    try:
        split = read_csv_feeds(spark, str(tmp_path), ["refunds"])["refunds"]
        whole = read_csv_feeds(spark, str(tmp_path), ["refunds"], line_breaks=["refunds"])["refunds"]
        assert split.rdd.getNumPartitions() > 4 and whole.rdd.getNumPartitions() == 1
        assert rows(split) == rows(whole) and split.count() == 500
    finally:
        spark.conf.set(key, before)


def test_csv_feeds_written_and_read_keep_empty_and_missing_texts(spark, tmp_path):
    lines = [{"refund_id": "r1", "reason": ""}, {"refund_id": "r2"}, {"refund_id": "r3", "reason": 'a "b", c'}]
    raw = feed(spark, "refunds", lines)
    write_csv_feeds({"refunds": raw}, str(tmp_path), ["refunds"])
    read = read_csv_feeds(spark, str(tmp_path), ["refunds"])["refunds"]
    assert rows(read, "refund_id", "reason")[2] == ("r3", 'a "b", c')
    assert {r.refund_id: r.reason for r in read.collect()}["r2"] is None


def test_times_do_not_lose_their_hours_or_zone_in_silence(spark):
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in feed(spark, "ad_insights", []).schema)
    landed = spark.createDataFrame([], kinds)
    at = landed.unionByName(spark.range(1).selectExpr("date'2026-02-01' as date_day"), allowMissingColumns=True)
    whole = at.withColumn("date_day", F.expr("cast(date_day as timestamp_ntz)"))
    assert rows(declared(whole, "ad_insights"), "date_day") == rows(at, "date_day")
    with pytest.raises(SparkRuntimeException, match="does not fit"):
        declared(whole.withColumn("date_day", F.expr("date_day + interval 1 hour")), "ad_insights").collect()
    zoned = feed(spark, "refunds", []).withColumn("created_at", F.current_timestamp())
    with pytest.raises(TypeError, match="zone"):
        declared(zoned, "refunds")


def test_every_link_can_be_read_back(spark):
    def event(i, session, day, channel, user="u"):
        named = _event(i, f"{day} 10:00:00", "purchase", session)
        return {**named, "source": channel, "user_pseudo_id": user, "campaign": "c"}

    orders = [
        {**order(f"o{i}", None if i == 2 else "c1", f"2026-02-0{1 + i // 3} 09:00:00"), "utm_source": "s", "utm_medium": "m", "utm_campaign": "c"}
        for i in range(5)
    ] + [order("o9", "c1", "2026-02-07 09:00:00")]
    events = [event(1, "a", "2026-02-01", "s"), event(2, "b", "2026-02-01", "s"), event(3, "c", "2026-02-02", "s"),
              event(4, "d", "2026-02-01", "other"), event(5, "e", "2026-02-05", "s")]
    m = models(spark, orders=orders, web_events=events)
    members = intermediate.link_members(m["stg_web_sessions"], m["stg_orders"])
    assert members.count() == 3 + 5
    assert rows(intermediate.link_counts(members), "sessions", "orders", "links") == [(1, 2, 2), (2, 3, 6)]
    everything = {("a", "o0"), ("a", "o1"), ("a", "o2"), ("b", "o0"), ("b", "o1"), ("b", "o2"), ("c", "o3"), ("c", "o4")}

    def pairs(schema, *values):
        wanted = spark.createDataFrame(values, schema)
        return {(r.session_id, r.order_id) for r in intermediate.links(members, wanted).collect()}

    assert pairs("session_source string", ("s",)) == everything
    assert pairs("user_pseudo_id string, session_id string", ("u", "b"), ("u", "d")) == {p for p in everything if p[0] == "b"}
    assert pairs("order_id string", ("o2",), ("o9",)) == {("a", "o2"), ("b", "o2")}
    # What the summary per session says of the same links.
    summary = {r.session_id: r.linked_orders for r in m["int_sessions_attributed"].collect()}
    assert summary == {"a": 3, "b": 3, "c": 2, "d": 0, "e": 0}


def test_newest_order_of_a_fact_is_a_subquery_of_the_plan(spark, tmp_path):
    m = models(spark, orders=[order(f"o{i}", "c1", f"2026-0{i}-01 10:00:00") for i in range(1, 7)])
    earlier = m["fct_orders"].where("order_id < 'o4'")
    earlier.write.parquet(str(tmp_path / "fact"))
    m["stg_orders"].write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    taken = orders_beyond(orders, spark.read.parquet(str(tmp_path / "fact")))
    assert rows(taken, "order_id") == [("o3",), ("o4",), ("o5",), ("o6",)]
    plan = taken._jdf.queryExecution().executedPlan().toString()
    assert "2026-03-01" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "order_id" in line)
    assert "ubquery" in scan
    assert rows(orders_beyond(orders, spark.read.parquet(str(tmp_path / "fact")).limit(0)), "order_id") == rows(orders, "order_id")


def test_views_last_and_agree_with_the_models(spark, sf_dir):
    feeds, schema = CommerceFeeds(spark, sf_dir), scratch_schema(spark, f"views_{uuid.uuid4().hex}")
    write_catalog_feeds(spark, feeds, schema)
    made = create_permanent_views(spark.newSession(), schema, feeds=schema)
    direct, other = Models(spark, feeds, DRIVER_SETTINGS), spark.newSession()
    assert {name.split(".")[1] for name in made} == set(STAGING)
    for name in STAGING:
        view = other.table(f"{schema}.{name}")
        assert view.columns == direct[name].columns
        assert [kind(t) for _, t in view.dtypes] == [kind(t) for _, t in direct[name].dtypes], name
        assert rows(view) == rows(direct[name]), name
    described = documentation_of(other, [schema]).where("table_name = 'stg_customers' and column_name = 'email'")
    assert described.first()["comment"] == "Personal data."
    # A view follows its feed.
    write_catalog_feeds(spark, {"refunds": feeds["refunds"].limit(0)}, schema)
    assert spark.newSession().table(f"{schema}.stg_refunds").count() == 0
