from datetime import datetime

import pytest
from fixtures import models, order, rows
from pyspark.sql import functions as F

from tidemart.operators.upsert import last_load, upsert_table
from tidemart.plans import quality, warehouse
from tidemart.plans.observation import Observed


def test_keys_nulls_values_and_ranges(spark):
    people = spark.createDataFrame(
        [(1, "a", 5), (1, "b", -1), (2, None, None), (None, "z", 7), (None, "z", 8)],
        "id int, kind string, n int",
    )
    tables = {"t": people}
    assert rows(quality.unique(tables, {"t": ("id",)})) == [("t", "id", 1, "fail")]
    assert rows(quality.unique_combination(tables, {"t": ("id", "kind")})) == [("t", "id,kind", 1, "fail")]
    # Nulls are left out column by column, and keys of several types are told apart.
    both = rows(quality.unique(tables, {"t": ("id", "kind", "n")}))
    assert both == [("t", "id", 1, "fail"), ("t", "kind", 1, "fail"), ("t", "n", 0, "pass")]
    assert rows(quality.not_null(tables, {"t": ("id", "n")})) == [("t", "id", 2, "fail"), ("t", "n", 1, "fail")]
    assert rows(quality.accepted_values(tables, {("t", "kind"): ("a", "b", "z")})) == [("t", "kind", 0, "pass")]
    assert rows(quality.accepted_values(tables, {("t", "kind"): ("a",)})) == [("t", "kind", 3, "fail")]
    assert rows(quality.between(tables, {("t", "n"): (0, None)})) == [("t", "n", 1, "fail")]
    assert rows(quality.between(tables, {("t", "n"): (0, 6)})) == [("t", "n", 3, "fail")]


def test_relationships_count_child_rows(spark):
    tables = {
        "child": spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"),
        "parent": spark.createDataFrame([(1,), (3,)], "id int"),
    }
    rule = {("child", "k"): ("parent", "id"), ("parent", "id"): ("parent", "id")}
    assert rows(quality.relationships(tables, rule)) == [
        ("child", "k", 2, "fail"),
        ("parent", "id", 0, "pass"),
    ]


def test_freshness_levels(spark):
    tables = {
        "feed": spark.createDataFrame([(datetime(2026, 1, 1),), (datetime(2026, 1, 2),)], "at timestamp_ntz"),
        "empty": spark.createDataFrame([], "at timestamp_ntz"),
    }

    def status(table, column, as_of):
        return rows(quality.freshness(tables, as_of, {table: (column, 6, 24)}), "status")[0][0]

    assert status("feed", "at", datetime(2026, 1, 2, 6)) == "pass"
    assert status("feed", "at", datetime(2026, 1, 2, 7)) == "warn"
    assert status("feed", "at", datetime(2026, 1, 3, 1)) == "error"
    assert status("feed", "missing", datetime(2026, 1, 2)) == "error"
    assert status("empty", "at", datetime(2026, 1, 2)) == "error"


def test_business_rules_return_the_offending_rows(spark):
    m = models(
        spark,
        orders=[
            order("o1", "c1", "2026-07-01 00:00:01", 10, source_name="web"),
            order("o2", "c1", "2026-07-01 00:00:00", -1, source_name=""),
            order("o3", "c1", "2026-06-01 00:00:00", 10, utm_source="x"),
        ],
    )
    fct = m["fct_orders"]
    assert rows(quality.future_orders(fct, m.settings.as_of), "order_id") == [("o1",)]
    assert rows(quality.negative_subtotals(fct), "order_id") == [("o2",)]
    assert rows(quality.unattributed_orders(fct), "order_id") == [("o2",)]
    assert rows(quality.incomplete_first_months(m["customer_cohort_retention"])) == []
    counted = quality.offending(quality.future_orders(fct, m.settings.as_of), "fct_orders", "ordered_at")
    assert rows(counted) == [("fct_orders", "ordered_at", 1, "fail")]


def test_row_rules_are_counted_while_the_tables_are_written(spark, tmp_path):
    """The same failures as from scans, with no table read by the checks themselves."""
    m = models(
        spark,
        orders=[
            order("o1", None, "2026-02-01 10:00:00", 10, financial_status="odd"),
            order("o2", "c1", None, 10),
            order("o3", "c1", "2026-03-01 10:00:00", 10),
        ],
        countries=[{"country_code": "US"}, {"country_code": None}],
    )
    observed = Observed()
    built = warehouse.build(m, str(tmp_path), names=warehouse.CHECKED, observed=observed)
    for name, scan in (
        ("dq_not_null", quality.not_null),
        ("dq_accepted_values", quality.accepted_values),
        ("dq_between", quality.between),
    ):
        counted = observed.failures(spark, name)
        assert rows(counted) == rows(scan(built))
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "Exchange" not in plan
    failing = {(t, c) for t, c, n, _ in rows(observed.failures(spark, "dq_not_null")) if n}
    assert {("raw_orders", "customer_id"), ("raw_countries", "country_code"), ("stg_orders", "ordered_at")} <= failing
    assert rows(observed.failures(spark, "dq_accepted_values"), "table_name", "failures")[0][1] is not None
    assert rows(built["fct_orders"]) == rows(m["fct_orders"])


def test_a_table_that_was_not_watched_raises(spark):
    rules = {"check": [("t", "id", F.col("id").isNull())]}
    observed = Observed(rules)
    with pytest.raises(ValueError, match="not watched"):
        observed.failures(spark, "check")
    people = spark.createDataFrame([(1,), (None,)], "id int")
    observed.watching("t", people).write.format("noop").mode("overwrite").save()
    assert rows(observed.failures(spark, "check")) == [("t", "id", 1, "fail")]
    observed.watching("t", people.limit(0)).write.format("noop").mode("overwrite").save()
    assert rows(observed.failures(spark, "check")) == [("t", "id", 0, "pass")]


def test_checks_of_one_load(spark, table):
    def put(rows, **options):
        upsert_table(spark.createDataFrame(rows, "id int, parent int, part string"), table, ["id"], "part", **options)

    parents = spark.createDataFrame([(1,), (2,)], "key int")

    def check():
        return rows(quality.of_load(*last_load(spark, table), "t", ["id"], {"parent": (parents, "key")}))

    put([(1, 1, "a"), (2, 9, "a"), (3, 1, "b"), (4, None, None), (None, 1, "c"), (None, 1, "c")])
    assert check() == [("t", "id", 0, "pass"), ("t", "parent", 1, "fail")]
    # 1 and 4 come again in partitions that the load does not search; the orphan of a is not its matter.
    put([(1, 2, "b"), (5, 7, "b"), (5, 7, "b")], rows_move=False)
    assert check() == [("t", "id", 2, "fail"), ("t", "parent", 2, "fail")]
    # Moved for good: the partitions it left are rewritten too, and so are theirs to check.
    put([(1, 2, "d")])
    assert check() == [("t", "id", 1, "fail"), ("t", "parent", 3, "fail")]
