import random
from collections import Counter
from pathlib import Path
from unittest import mock
from urllib.parse import unquote, urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.operators import upsert
from tidemart.operators.lookup import is_one_of, with_keys
from tidemart.operators.quantiles import ntile_scores
from tidemart.operators.skew import splittable_join
from tidemart.operators.upsert import latest_per_key, read_table, upsert_rows, upsert_table


def ntile(values, buckets):
    """Brute force: sorted (value, id) cut into buckets, the first ones one longer."""
    ranked = sorted(values, key=lambda pair: (pair[1], pair[0]))
    size, larger = divmod(len(ranked), buckets)
    out, start = {}, 0
    for bucket in range(1, buckets + 1):
        end = start + size + (bucket <= larger)
        out.update({key: bucket for key, _ in ranked[start:end]})
        start = end
    return out


def check_ntile(spark, pairs, buckets, partitions):
    df = spark.createDataFrame(pairs, "id int, v int").repartition(partitions)
    scored = ntile_scores(df, "id", {"up": ("v", True)}, buckets)
    got = {r["id"]: r["up"] for r in scored.collect()}
    assert got == ntile(pairs, buckets)
    assert {r["id"]: r["v"] for r in scored.collect()} == dict(pairs)


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 23])
def test_ntile_of_few_rows(spark, n):
    check_ntile(spark, [(i, (i * 7) % 4) for i in range(n)], 5, 3)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 6), max_size=120), st.sampled_from([1, 3, 5, 7]))
def test_ntile_with_ties(spark, values, buckets):
    check_ntile(spark, list(enumerate(values)), buckets, 5)


def test_ntile_several_scores_at_once(spark):
    rng = random.Random(1)
    data = [(i, rng.randint(0, 50), rng.choice([1, 1, 1, 2, 9])) for i in range(5000)]
    df = spark.createDataFrame(data, "id int, a int, b int")
    scored = ntile_scores(df, "id", {"down": ("a", False), "up": ("b", True)}, 5).collect()
    down = ntile([(i, -a) for i, a, _ in data], 5)
    up = ntile([(i, b) for i, _, b in data], 5)
    assert {r["id"]: (r["down"], r["up"]) for r in scored} == {i: (down[i], up[i]) for i, *_ in data}


def test_ntile_ranks_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "id int, v int")
    scored = ntile_scores(df, "id", {"down": ("v", False), "up": ("v", True)}, 3)
    got = {r["id"]: (r["v"], r["down"], r["up"]) for r in scored.collect()}
    assert got == {1: (None, 3, 3), 2: (5, 1, 2), 3: (1, 2, 1)}


def test_ntile_has_no_single_partition_step(spark):
    df = spark.range(10_000).select(F.col("id"), (F.col("id") % 3).cast("int").alias("v"))
    plan = ntile_scores(df, "id", {"s": ("v", True)}, 5)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def skewed(spark):
    """Two thirds of the rows on one key, some without a key."""
    rows = [(i, "hot" if i % 3 else f"k{i % 50}") for i in range(3000)]
    rows += [(i, None) for i in range(3000, 3300)]
    return spark.createDataFrame(rows, "id int, k string")


def per_key(left):
    """One row per key, as an aggregate on it."""
    return left.groupBy("k").agg(F.min("id").alias("least"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_splittable_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = per_key(left.where("id % 7 > 0 and k <> 'k9'"))
    joined, plain = splittable_join(left, right, ["k"], how), left.join(right, "k", how)
    assert joined.columns == plain.columns
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, plain.collect()))


def test_splittable_join_splits_a_hot_key(spark):
    rows = spark.range(60_000).select("id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    left = rows.withColumn("text", F.sha2(F.col("id").cast("string"), 512)).repartition(8)
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {key: spark.conf.get(key, None) for key in changes}
    for key, value in changes.items():
        spark.conf.set(key, value)
    try:
        execution = [
            join._jdf.queryExecution()
            for join in (splittable_join(left, per_key(rows), ["k"]), left.join(per_key(rows), "k"))
        ]
        for each in execution:
            each.toRdd().count()
        split, plain = (each.executedPlan().toString() for each in execution)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "skew=true" in split and "skew=true" not in plain


def test_ntile_refuses_what_it_cannot_rank(spark):
    for kind in ("double", "decimal(20,4)", "string"):
        df = spark.createDataFrame([], f"id int, v {kind}")
        with pytest.raises(ValueError, match="cannot be ranked"):
            ntile_scores(df, "id", {"s": ("v", True)}, 5)


def test_upsert_rows_grows_the_schema(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "c", 5), (3, "d", 6)], "id int, v string, extra int")
    got = sorted(map(tuple, upsert_rows(old, new, ["id"]).collect()))
    assert got == [(1, "a", None), (2, "c", 5), (3, "d", 6)]


def test_latest_per_key(spark):
    rows = spark.createDataFrame([(1, 5, "x"), (1, 7, "y"), (2, 1, "z")], "id int, ver int, v string")
    assert sorted(map(tuple, latest_per_key(rows, ["id"], "ver").collect())) == [(1, 7, "y"), (2, 1, "z")]


SCHEMA = "id int, ver int, part string, v string"


def apply(spark, table, rows, schema=SCHEMA, **options):
    upsert_table(spark.createDataFrame(rows, schema), table, ["id"], "part", **options)
    return sorted(
        (r["id"], r["ver"], r["part"], r["v"]) for r in read_table(spark, table).collect()
    )


def test_upsert_table_replaces_adds_and_moves(spark, table):
    apply(spark, table, [(1, 1, "a", "one"), (2, 1, "a", "two"), (3, 1, "b", "three")])
    # 1 is replaced in place, 3 leaves partition b empty, 4 opens partition c.
    got = apply(spark, table, [(1, 2, "a", "ONE"), (3, 2, "a", "THREE"), (4, 1, "c", "four")])
    assert got == [(1, 2, "a", "ONE"), (2, 1, "a", "two"), (3, 2, "a", "THREE"), (4, 1, "c", "four")]
    # The same changes again change nothing.
    again = apply(spark, table, [(1, 2, "a", "ONE"), (3, 2, "a", "THREE"), (4, 1, "c", "four")])
    assert again == got


@pytest.mark.parametrize("probed", [0, 1, 500])
def test_rows_are_found_by_lookup_and_by_join_alike(spark, table, probed):
    first = [(i, 1, f"m{i % 7}", f"v{i}") for i in range(40)] + [(90, 1, None, "n"), (None, 1, "m1", "no id")]
    upsert_table(spark.createDataFrame(first, SCHEMA), table, ["id"], "part")
    changes = [(3, 2, "m6", "moved"), (5, 2, "m5", "same"), (90, 2, "m0", "dated"), (91, 1, None, "new")]
    upsert_table(spark.createDataFrame(changes, SCHEMA), table, ["id"], "part", probed=probed)
    got = {tuple(r) for r in read_table(spark, table).select("id", "ver", "part", "v").collect()}
    assert got == {r for r in first if r[0] not in (3, 5, 90)} | set(changes)


def test_lookup_reads_only_row_groups_that_may_hold_a_key(spark, table):
    rows = spark.range(40_000).selectExpr("id * 7919 % 1000003 as id", "id % 10 as part", "uuid() as v")
    upsert_table(rows, table, ["id"], "part")
    stored = spark.table(table)
    wanted = [r["id"] for r in stored.where("part = 3").limit(4).collect()]
    keys = spark.createDataFrame([(k,) for k in [*wanted, 2_000_000]], "id long")
    found = with_keys(stored.select("id", "part"), keys, ["id"])
    assert sorted(r["id"] for r in found.collect()) == sorted(wanted)
    leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
    read = sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
    # One of ten months, whose ids lie among those of the others.
    assert read == 4_000
    joined = with_keys(stored.select("id", "part"), keys, ["id"], probed=0)
    assert sorted(r["id"] for r in joined.collect()) == sorted(wanted)


def test_is_one_of(spark):
    rows = spark.range(100)
    for n in (0, 1, 9, 10, 11, 25, 64):
        assert [r["id"] for r in rows.where(is_one_of("id", list(range(n)))).collect()] == list(range(n))


def files(spark, table):
    shown = spark.table(upsert._state(spark, table).shown)
    return {r[0] for r in shown.select("_metadata.file_path").collect()}


def on_disk(file):
    return Path(unquote(urlparse(file).path)).exists()


def test_upsert_table_leaves_other_partitions_alone(spark, table):
    apply(spark, table, [(1, 1, "a", "one"), (2, 1, "b", "two")])
    before = files(spark, table)
    apply(spark, table, [(1, 2, "a", "ONE")])
    after = files(spark, table)
    assert len(before) == len(after) == 2 and len(before & after) == 1


def test_partition_values_of_any_text(spark, table):
    names = ["a b", "c/d", "e=f", "g%20h", "i'j", "k\\l", "m:n", "Ö", "", "x.y"]
    first = [(i, 1, name, "old") for i, name in enumerate(names)]
    apply(spark, table, first)
    got = apply(spark, table, [(i, 2, name, "new") for i, name in enumerate(names) if i % 2])
    # An empty text is the null partition, as in any table stored by folders.
    want = [(i, 2 if i % 2 else 1, name or None, "new" if i % 2 else "old") for i, name in enumerate(names)]
    assert got == want


def test_tables_go_one_commit_after_they_are_replaced(spark, table):
    apply(spark, table, [(1, 1, "a", "one")])
    planned, first = read_table(spark, table), files(spark, table)
    apply(spark, table, [(1, 2, "a", "two")])
    assert planned.first()["v"] == "one" and all(map(on_disk, first))
    apply(spark, table, [(1, 3, "a", "three")])
    assert not any(map(on_disk, first))
    assert len(upsert._behind(spark, table)) == 4
    upsert.drop_table(spark, table)
    assert read_table(spark, table) is None and not upsert._behind(spark, table)


@pytest.mark.parametrize("done", ["nothing", "all but the view"])
def test_call_that_breaks_off_before_the_commit(spark, table, monkeypatch, done):
    old = apply(spark, table, [(1, 1, "m1", "a"), (2, 1, "m1", "b"), (3, 1, "m2", "c")])
    commit = upsert._commit

    def fail(session, name, *rest):
        if done != "nothing":
            broken = mock.Mock(wraps=session)
            broken.sql = lambda text: 1 / 0 if "VIEW" in text else session.sql(text)
            commit(broken, name, *rest)
        raise ZeroDivisionError

    with monkeypatch.context() as patched:
        patched.setattr(upsert, "_commit", fail)
        with pytest.raises(ZeroDivisionError):
            apply(spark, table, [(1, 2, "m2", "A")])
    stored = sorted(map(tuple, read_table(spark, table).select("id", "ver", "part", "v").collect()))
    assert stored == old
    assert apply(spark, table, [(1, 2, "m2", "A")]) == [(1, 2, "m2", "A"), (2, 1, "m1", "b"), (3, 1, "m2", "c")]
    # What the broken-off call left is gone.
    assert len(upsert._behind(spark, table)) == 4


def test_first_call_that_breaks_off_leaves_no_table(spark, table, monkeypatch):
    with monkeypatch.context() as patched:
        patched.setattr(upsert, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            apply(spark, table, [(1, 1, "a", "one")])
    assert read_table(spark, table) is None
    assert apply(spark, table, [(1, 1, "a", "one")]) == [(1, 1, "a", "one")]


def test_another_session_reads_the_table(spark, table):
    got = apply(spark, table, [(1, 1, "a", "one")])
    assert [(r["id"], r["ver"], r["part"], r["v"]) for r in spark.newSession().table(table).collect()] == got


def test_table_may_become_and_stay_empty(spark, table):
    assert apply(spark, table, []) == []
    assert apply(spark, table, [(1, 1, "a", "one")]) == [(1, 1, "a", "one")]
    assert apply(spark, table, []) == [(1, 1, "a", "one")]


def test_equal_and_missing_versions(spark, table):
    apply(spark, table, [(1, 5, "a", "one"), (2, None, "a", "two")], version="ver")
    # Derived later at the same version: replaces. Null is older than any other version.
    assert apply(spark, table, [(1, 5, "a", "ONE")], version="ver") == [(1, 5, "a", "ONE"), (2, None, "a", "two")]
    changes = [(1, None, "a", "old"), (2, None, "a", "TWO"), (3, None, "b", "three")]
    got = apply(spark, table, changes, version="ver")
    assert got == [(1, 5, "a", "ONE"), (2, None, "a", "TWO"), (3, None, "b", "three")]


def test_newest_value_is_kept_with_the_table(spark, table):
    assert upsert.newest_value(spark, table) is None
    for version in (3, 2):
        apply(spark, table, [(version, version, "a", "x")], watermark="ver")
        assert upsert.newest_value(spark, table) == "3"


def test_upsert_table_ignores_an_older_version(spark, table):
    apply(spark, table, [(1, 5, "a", "new")], version="ver")
    assert apply(spark, table, [(1, 4, "a", "old")], version="ver") == [(1, 5, "a", "new")]


def test_upsert_table_appends_new_columns(spark, table):
    apply(spark, table, [(1, 1, "a", "one"), (2, 1, "b", "two")])
    apply(spark, table, [(1, 2, "a", "ONE", 9)], SCHEMA + ", extra int")
    got = {r["id"]: r["extra"] for r in read_table(spark, table).collect()}
    assert got == {1: 9, 2: None}


def test_upsert_table_keeps_rows_without_a_partition(spark, table):
    apply(spark, table, [(1, 1, None, "one"), (2, 1, None, "two")])
    got = apply(spark, table, [(1, 2, None, "ONE")])
    assert got == [(1, 2, None, "ONE"), (2, 1, None, "two")]


def test_upsert_table_with_fixed_partitions(spark, table):
    first = [(1, 5, "a", "one"), (2, 5, "b", "two")]
    apply(spark, table, first, version="ver", rows_move=False)
    changes = [(1, 4, "a", "old"), (2, 6, "b", "TWO"), (3, 1, "c", "three")]
    got = apply(spark, table, changes, version="ver", rows_move=False)
    assert got == [(1, 5, "a", "one"), (2, 6, "b", "TWO"), (3, 1, "c", "three")]
