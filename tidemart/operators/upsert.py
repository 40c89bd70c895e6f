"""Keyed upsert into a partitioned catalog table, one writer at a time.

What is read is a view. It shows a catalog table whose partitions point into the tables that the loads
wrote: a load writes only the partitions it touches, as a table of its own, makes a table that points there for these
partitions and where the view's table does for all others, and then replaces the view. That is one operation of the
catalog: until then readers see the table as it was, and a load that broke off has changed nothing.
The view's properties say which load holds each partition, and the highest value of a watermark column.
Tables that neither the newest nor the previous view shows go after a commit, so a result planned
just before it can still be read.

The tables last as long as the session's catalog: with the in-memory one until the application ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.lookup import PROBED, with_bloom_filters, with_keys
from tidemart.session import scratch_table

# Properties of a view; partitions are named by value, the null partition has no value.
_NUMBER, _SHOWN, _NEWEST, _HOLDS = "load.number", "load.shown", "load.newest", "load.holds"


@dataclass(frozen=True)
class State:
    """What a view shows: its table, and per partition value the load's table and the place of the files."""

    number: int = 0
    shown: str | None = None
    newest: str | None = None
    holds: dict[str | None, tuple[str, str]] = field(default_factory=dict)

    def tables(self) -> set[str]:
        return {load for load, _ in self.holds.values()} | ({self.shown} if self.shown else set())

    def properties(self) -> dict[str, str]:
        fixed = {_NUMBER: str(self.number), _SHOWN: self.shown, _NEWEST: self.newest}
        places = {_HOLDS if v is None else f"{_HOLDS}.{v}": " ".join(at) for v, at in self.holds.items()}
        return {name: value for name, value in {**fixed, **places}.items() if value is not None}


def _text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _state(spark: SparkSession, table: str) -> State:
    if not spark.catalog.tableExists(table):
        return State()
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    holds = {}
    for name, value in kept.items():
        if name == _HOLDS or name.startswith(f"{_HOLDS}."):
            load, _, place = value.partition(" ")
            holds[None if name == _HOLDS else name.removeprefix(f"{_HOLDS}.")] = load, place
    return State(int(kept[_NUMBER]), kept[_SHOWN], kept.get(_NEWEST), holds)


def read_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The table as last committed, or None if nothing was ever committed."""
    return spark.table(table) if spark.catalog.tableExists(table) else None


def newest_value(spark: SparkSession, table: str) -> str | None:
    """The highest value of the watermark column that was ever committed, as text."""
    return _state(spark, table).newest


def last_load(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame]:
    """The table in two parts: the partitions that the last load wrote, and all others as they stood before."""
    state = _state(spark, table)
    if state.shown is None:
        raise ValueError(f"nothing was ever committed to {table}")
    rows, load = spark.table(state.shown), state.shown.removesuffix("_shown") + "_load"
    # A parquet table has its partition column last.
    column = rows.columns[-1]
    written = _is_in(column, {v for v, (held, _) in state.holds.items() if held == load})
    return rows.where(written), rows.where(~written)


def drop_table(spark: SparkSession, table: str) -> None:
    """Remove the view and all tables behind it."""
    behind = _behind(spark, table)
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    for name in behind:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _behind(spark: SparkSession, table: str) -> set[str]:
    """Tables of loads and of what views showed, those of broken-off loads included."""
    schema, _, name = table.rpartition(".")
    found = spark.sql(f"SHOW TABLES IN {schema} LIKE '{name}__*'").collect()
    return {f"{schema}.{r['tableName']}" for r in found}


def _commit(spark: SparkSession, table: str, load: str, now: State, following: State, partition: str) -> None:
    """Make the table that points at all partitions, and show it."""
    schema = table.rpartition(".")[0]
    root = spark.catalog.getDatabase(schema).locationUri.rstrip("/")
    place = _text(f"{root}/{following.shown.rpartition('.')[2]}")
    spark.sql(f"CREATE TABLE {following.shown} LIKE {load} USING parquet LOCATION {place}")
    places = " ".join(
        f"PARTITION (`{partition}` = {'null' if value is None else _text(value)}) LOCATION {_text(at)}"
        for value, (_, at) in following.holds.items()
    )
    if places:
        spark.sql(f"ALTER TABLE {following.shown} ADD {places}")
    kept = ", ".join(f"{_text(name)} = {_text(value)}" for name, value in following.properties().items())
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({kept}) AS SELECT * FROM {following.shown}")
    for old in _behind(spark, table) - {t.lower() for t in following.tables() | now.tables()}:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def upsert_rows(existing: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """``existing`` with rows replaced by, or added from, ``changes``.

    A column only one side has is kept and is null on the other side's rows.
    """
    kept = existing.join(changes.select(*key), list(key), "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def latest_per_key(rows: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """The row with the highest ``version`` per key.

    Equal versions are settled by the row itself; a null version is older than any other.
    """
    row = F.struct(*rows.columns)
    newest = F.max_by(row, F.struct(F.col(version), row)).alias("row")
    return rows.groupBy(*key).agg(newest).select("row.*")


def balanced(rows: DataFrame, partition: str) -> DataFrame:
    """Rows dealt out by ``partition`` for files of a sensible size.

    The rebalance lets adaptive execution merge small partitions and split one that holds
    much of the data.
    """
    return rows.hint("rebalance", F.col(partition))


def _is_in(partition: str, values: Collection) -> Column:
    """Rows of some partitions; None is the null partition."""
    known = [v for v in values if v is not None]
    found = F.col(partition).isin(*known) if known else F.lit(False)
    # Never null, so that it can be turned round.
    return F.coalesce(found, F.lit(False)) | F.col(partition).isNull() if None in values else found.eqNullSafe(True)


def partitions_of(rows: DataFrame, partition: str) -> set:
    """The partition values of some rows, one each, which the calendar bounds."""
    return {r[0] for r in rows.select(partition).distinct().collect()}


def _changed(
    existing: DataFrame,
    changes: DataFrame,
    key: list[str],
    partition: str,
    version: str | None,
    rows_move: bool,
    probed: int,
) -> tuple[set, DataFrame]:
    """The partitions that some changes touch, and their rows after the changes."""
    touched = partitions_of(changes, partition)
    # A row without a partition may get one at any time.
    searched = existing if rows_move else existing.where(F.col(partition).isNull())
    old = with_keys(searched.select(*dict.fromkeys([*key, partition])), changes, key, probed)
    touched |= partitions_of(old, partition)
    existing = existing.where(_is_in(partition, touched))
    if version is not None:
        stored = existing.select(*key, F.lit(True).alias("is_stored"), F.col(version).alias("stored_version"))
        newer = F.col("is_stored").isNull() | F.col("stored_version").isNull()
        newer |= F.col(version) >= F.col("stored_version")
        changes = changes.join(stored, key, "left").where(newer).drop("is_stored", "stored_version")
    return touched, upsert_rows(existing, changes, key)


def upsert_table(
    changes: DataFrame,
    table: str,
    key: Sequence[str],
    partition: str,
    version: str | None = None,
    rows_move: bool | None = None,
    watermark: str | None = None,
    probed: int = PROBED,
) -> None:
    """Apply ``changes`` (one row per key) to the catalog table ``table``, named with its schema.

    Only partitions that hold a changed row, before or after the change, are read in full
    and rewritten. Where changed rows were before is looked up by key in the files' Bloom filters, for
    ``probed`` keys at most; for more, the key columns of the whole table are joined with them. When
    ``rows_move`` is False only the null partition is searched, which is safe if
    a key never changes its partition once it has one and is assumed when the partition column is
    part of the key.

    Applying the same changes twice leaves the same table. With ``version``, a change older than
    the stored row is dropped, so a late replay cannot undo a newer one. A change with the stored
    row's version replaces it, as it was derived later. A null version is older than any other.

    A call that breaks off at any point leaves the table as it was; repeating it completes it.
    ``watermark`` names a column whose highest value is kept with the table.
    """
    spark, key = changes.sparkSession, list(key)
    now = _state(spark, table)
    rows_move = partition not in key if rows_move is None else rows_move
    name = f"{table}__{now.number + 1:06d}_{uuid.uuid4().hex[:8]}"
    load = f"{name}_load"

    def write(rows: DataFrame) -> None:
        writer = with_bloom_filters(balanced(rows, partition).write, key)
        writer.partitionBy(partition).format("parquet").saveAsTable(load)

    if now.shown:
        # Several jobs read the changes, and their plan may read the table that is rewritten.
        with scratch_table(changes, "changes") as marked:
            existing = spark.table(now.shown)
            touched, rows = _changed(existing, marked, key, partition, version, rows_move, probed)
            write(rows)
    else:
        touched = set()
        write(changes)

    as_text = F.col(partition).cast("string")
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)
    highest = F.max(F.col(watermark).cast("string")) if watermark else F.lit(None).cast("string")
    written = spark.table(load).groupBy(as_text.alias("part"), folder.alias("folder")).agg(highest.alias("newest"))
    places = written.collect()  # a row per partition
    newest = max((v for v in (now.newest, *(r["newest"] for r in places)) if v is not None), default=None)
    gone = {None if v is None else str(v) for v in touched}
    holds = {v: at for v, at in now.holds.items() if v not in gone}
    holds |= {r["part"]: (load, unquote(r["folder"])) for r in places}
    following = State(now.number + 1, f"{name}_shown", newest, holds)
    _commit(spark, table, load, now, following, partition)
