"""Data-quality checks. Each returns (table_name, column_name, failures, status).

Null, vocabulary and range checks of one table share a single column-pruned pass. Key and
reference checks group by the key first, so a key that many rows share is reduced before
it is shuffled. Run them over stored marts to scan columns instead of deriving tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemart.functions.columns import DIRECT_SOURCE, count_if, zero_if_null
from tidemart.operators.lookup import PROBED, with_keys
from tidemart.plans import contracts

Tables = Mapping[str, DataFrame]
# A table, a column, and what is true of a row that breaks the rule.
Rule = tuple[str, str, Column]


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def with_status(results: DataFrame) -> DataFrame:
    return results.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def _count_failures(
    df: DataFrame, table: str, failing: Sequence[tuple[str, Column]]
) -> DataFrame:
    """One row per (column, condition) from one pass over ``df``."""
    counts = df.agg(*[count_if(condition).alias(f"c{i}") for i, (_, condition) in enumerate(failing)])
    rows = [
        F.struct(F.lit(column).alias("column_name"), F.col(f"c{i}").alias("failures"))
        for i, (column, _) in enumerate(failing)
    ]
    return counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))


def _by_table(failing: Iterable[Rule], tables: Tables) -> DataFrame:
    grouped: dict[str, list[tuple[str, Column]]] = {}
    for table, column, condition in failing:
        grouped.setdefault(table, []).append((column, condition))
    return with_status(
        _union(_count_failures(tables[t], t, conditions) for t, conditions in grouped.items())
    )


def not_null_rules(contract=contracts.NOT_NULL) -> list[Rule]:
    return [(t, c, F.col(c).isNull()) for t, columns in contract.items() for c in columns]


def accepted_values_rules(contract=contracts.ACCEPTED_VALUES) -> list[Rule]:
    return [(t, c, ~F.col(c).isin(*values)) for (t, c), values in contract.items()]


def between_rules(contract=contracts.BETWEEN) -> list[Rule]:
    def outside(column: str, low, high) -> Column:
        below = F.col(column) < low if low is not None else F.lit(False)
        above = F.col(column) > high if high is not None else F.lit(False)
        return below | above

    return [(t, c, outside(c, low, high)) for (t, c), (low, high) in contract.items()]


def row_rules() -> dict[str, list[Rule]]:
    """The rules that look at one row at a time, by check."""
    return {
        "dq_not_null": not_null_rules(),
        "dq_accepted_values": accepted_values_rules(),
        "dq_between": between_rules(),
    }


def not_null(tables: Tables, contract=contracts.NOT_NULL) -> DataFrame:
    return _by_table(not_null_rules(contract), tables)


def accepted_values(tables: Tables, contract=contracts.ACCEPTED_VALUES) -> DataFrame:
    return _by_table(accepted_values_rules(contract), tables)


def between(tables: Tables, contract=contracts.BETWEEN) -> DataFrame:
    return _by_table(between_rules(contract), tables)


def _stacked(parts: Iterable[DataFrame]) -> list[DataFrame]:
    """Parts whose keys have the same type stacked to one, so that no key changes its type."""
    by_type: dict[str, list[DataFrame]] = {}
    for part in parts:
        by_type.setdefault(part.schema["key"].dataType.simpleString(), []).append(part)
    return [_union(same) for same in by_type.values()]


def _duplicate_keys(
    tables: Tables, keys: Sequence[tuple[str, tuple[str, ...]]], skip_nulls: bool
) -> DataFrame:
    """Number of key values held by more than one row, one shuffle per type of key.

    Keys with texts are shuffled as hashes. That pass runs at once; only the keys whose hash two rows
    share, if there are any, are then counted as they stand.
    """

    def tagged(i: int, table: str, columns: tuple[str, ...]) -> DataFrame:
        present = tables[table].dropna("any", subset=list(columns)) if skip_nulls else tables[table]
        return present.select(F.lit(i).alias("rule"), F.struct(*columns).alias("key"))

    def renamed(part: DataFrame) -> DataFrame:
        fields = [F.col(f"key.{f.name}").alias(f"k{n}") for n, f in enumerate(part.schema["key"].dataType)]
        return part.select("rule", F.struct(*fields).alias("key"))

    parts = [renamed(tagged(i, *key)) for i, key in enumerate(keys)]
    narrow = [part for part in parts if not _has_text(part)]
    doubtful = _with_shared_hash({i: part for i, part in enumerate(parts) if _has_text(part)})
    repeated = [_repeated(part).select("rule") for part in _stacked([*narrow, *doubtful])]
    names = [(table, ",".join(columns)) for table, columns in keys]
    if not repeated:
        return _per_rule(parts[0].sparkSession.createDataFrame([], "rule int, failures bigint"), names)
    return _per_rule(_union(repeated).groupBy("rule").agg(F.count(F.lit(1)).alias("failures")), names)


def _repeated(part: DataFrame) -> DataFrame:
    return part.groupBy("rule", "key").count().where("count > 1")


def _has_text(part: DataFrame) -> bool:
    return any(isinstance(f.dataType, StringType) for f in part.schema["key"].dataType)


def _digest() -> Column:
    return F.xxhash64("key")


def _with_shared_hash(parts: Mapping[int, DataFrame]) -> list[DataFrame]:
    """Of each part, by rule, the rows whose hash another row has; parts without any are left out.

    Up to ``PROBED`` shared hashes are looked up; with more of them all parts are taken whole.
    """
    if not parts:
        return []
    hashed = _union(part.select("rule", _digest().alias("key")) for part in parts.values())
    shared: dict[int, list[int]] = {}
    for rule, digest in _repeated(hashed).select("rule", "key").limit(PROBED + 1).collect():
        shared.setdefault(rule, []).append(digest)
    if sum(map(len, shared.values())) > PROBED:
        return list(parts.values())
    return [parts[rule].where(_digest().isin(*digests)) for rule, digests in shared.items()]


def _per_rule(failures: DataFrame, names: Sequence[tuple[str, str]]) -> DataFrame:
    """Name each rule and add the ones without failures. One row per declared rule."""
    spark = failures.sparkSession
    rules = spark.createDataFrame(
        [(i, *name) for i, name in enumerate(names)], "rule int, table_name string, column_name string"
    )
    found = rules.join(failures, "rule", "left")
    return with_status(
        found.select(
            "table_name", "column_name", F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures")
        )
    )


def unique(tables: Tables, contract=contracts.UNIQUE) -> DataFrame:
    """Nulls are not keys."""
    keys = [(t, (c,)) for t, columns in contract.items() for c in columns]
    return _duplicate_keys(tables, keys, skip_nulls=True)


def unique_combination(tables: Tables, contract=contracts.UNIQUE_COMBINATIONS) -> DataFrame:
    return _duplicate_keys(tables, list(contract.items()), skip_nulls=False)


def relationships(tables: Tables, contract=contracts.RELATIONSHIPS) -> DataFrame:
    """Number of child rows whose key the parent does not hold, one shuffle per type of key.

    Child rows and parent keys are stacked and grouped by key. Both are reduced before the
    shuffle, so a key shared by many children costs one row per task. Keys keep their type where
    child and parent agree and are compared as text otherwise.
    """
    parts = []
    for i, ((child, column), (parent, parent_column)) in enumerate(contract.items()):
        agree = tables[child].schema[column].dataType == tables[parent].schema[parent_column].dataType
        key, other = (F.col(c) if agree else F.col(c).cast("string") for c in (column, parent_column))
        of_child = tables[child].where(key.isNotNull())
        pair = (
            of_child.select(F.lit(i).alias("rule"), key.alias("key"), F.lit(1).alias("child")),
            tables[parent].select(F.lit(i).alias("rule"), other.alias("key"), F.lit(0).alias("child")),
        )
        parts.append(_union(pair))
    orphans = _union(
        part.groupBy("rule", "key")
        .agg(F.sum("child").alias("children"), F.min("child").alias("parentless"))
        .where("parentless = 1")
        .select("rule", "children")
        for part in _stacked(parts)
    )
    return _per_rule(orphans.groupBy("rule").agg(F.sum("children").alias("failures")), list(contract))


def of_load(
    loaded: DataFrame,
    others: DataFrame,
    table: str,
    key: Sequence[str],
    references: Mapping[str, tuple[DataFrame, str]],
) -> DataFrame:
    """Key and reference checks of one load: of ``loaded``, the partitions it wrote, against the rest.

    Counts the keys that more than one loaded row has or a row of ``others`` has too, and the loaded rows whose
    reference (column to parent and its column) the parent does not hold. The other partitions are searched
    for the loaded keys only, by their files' Bloom filters where the load is small; nulls are no keys.
    """
    keys = loaded.dropna("any", subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    elsewhere = with_keys(others.select(*key), keys, key)
    repeated = keys.where("n > 1").select(*key).unionByName(elsewhere).distinct()
    counts = [(",".join(key), repeated.agg(F.count(F.lit(1)).alias("failures")))]
    for column, (parent, parent_column) in references.items():
        children = loaded.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        held = parent.select(F.col(parent_column).alias(column))
        orphans = children.join(held, column, "left_anti")
        counts.append((column, orphans.agg(zero_if_null(F.sum("n")).alias("failures"))))
    named = (F.lit(table).alias("table_name"), "column_name", "failures")
    return with_status(_union(c.withColumn("column_name", F.lit(name)).select(*named) for name, c in counts))


def freshness(tables: Tables, as_of: datetime, contract=contracts.FRESHNESS) -> DataFrame:
    """Age of the newest row of each feed against its warning and error thresholds.

    Returns (table_name, column_name, age_seconds, status). A feed without the named
    column, or without rows, is an error.
    """

    def age(table: str, column: str, warn_hours: int, error_hours: int) -> DataFrame:
        feed = tables[table]
        names = F.lit(table).alias("table_name"), F.lit(column).alias("column_name")
        if column not in feed.columns:
            newest = feed.sparkSession.range(1).select(F.lit(None).cast("timestamp_ntz").alias("newest"))
        else:
            newest = feed.agg(F.max(column).cast("timestamp_ntz").alias("newest"))
        now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
        seconds = F.timestamp_diff("SECOND", F.col("newest"), now)
        status = (
            F.when(seconds.isNull() | (seconds > error_hours * 3600), "error")
            .when(seconds > warn_hours * 3600, "warn")
            .otherwise("pass")
        )
        return newest.select(*names, seconds.alias("age_seconds"), status.alias("status"))

    return _union(age(t, *rule) for t, rule in contract.items())


# --- business rules: the offending rows ------------------------------------------------


def future_orders(fct_orders: DataFrame, as_of: date) -> DataFrame:
    """Orders stamped later than the end of the as-of day."""
    latest = F.timestamp_add("DAY", F.lit(1), F.lit(as_of.isoformat()).cast("timestamp_ntz"))
    return fct_orders.where(F.col("ordered_at") > latest).select("order_id", "ordered_at")


def negative_subtotals(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.where("order_subtotal < 0").select("order_id", "order_subtotal")


def unattributed_orders(fct_orders: DataFrame) -> DataFrame:
    """Orders with neither a UTM source nor a sales channel."""
    no_utm = F.coalesce(F.col("utm_source"), F.lit(DIRECT_SOURCE)) == DIRECT_SOURCE
    no_channel = F.coalesce(F.col("source_name"), F.lit("")) == ""
    return fct_orders.where(no_utm & no_channel).select("order_id", "utm_source", "source_name")


def incomplete_first_months(retention: DataFrame) -> DataFrame:
    """Cohorts whose first month does not show every member as active."""
    return retention.where("months_since_acquisition = 0 and retention_rate <> 1.0").select(
        "cohort_month", "months_since_acquisition", "retention_rate"
    )


def offending(rows: DataFrame, table: str, column: str) -> DataFrame:
    """Count of offending rows in the common result shape."""
    return with_status(
        rows.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "failures"
        )
    )
