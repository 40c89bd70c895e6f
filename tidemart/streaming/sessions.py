"""Web sessions kept current from a stream of events.

Each micro-batch is grouped on its own, without state, into one partial row per session and day,
stored under the number of its batch. A replayed batch replaces its own partials and nothing
else, so no event is counted twice, and however late an event comes it is not dropped. A session
is the roll-up of its partials, read on demand; ``compact_sessions`` merges old batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.functions.columns import MONEY, earliest, flag_any, sum_money
from tidemart.plans.staging import FUNNEL_EVENTS, SESSION_KEY
from tidemart.session import Folder

EVENT_DAY = "event_day"
PART_KEY = [*SESSION_KEY, EVENT_DAY]


def session_parts(events: DataFrame) -> DataFrame:
    """Per session and day of some events: everything needed to finish the session later."""
    named = F.col("event_name")
    value = F.when(named == "purchase", F.col("event_value")).otherwise(0)
    touch = F.struct("event_timestamp", "event_id", "source", "medium", "campaign")
    return events.groupBy(*SESSION_KEY, F.to_date("event_timestamp").alias(EVENT_DAY)).agg(
        F.min_by(touch, earliest("event_timestamp", "event_id")).alias("first"),
        F.max("event_timestamp").alias("ended_at"),
        F.max("ga_session_number").alias("number"),
        *[flag_any(named == name).alias(f"had_{name}") for name in FUNNEL_EVENTS],
        F.count(F.when(named == "page_view", 1)).alias("page_views"),
        sum_money(value).cast(MONEY).alias("purchases"),
    )


def _rolled(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(
        F.min_by("first", earliest("first.event_timestamp", "first.event_id")).alias("first"),
        F.max("ended_at").alias("ended_at"),
        F.max("number").alias("number"),
        *[F.max(f"had_{name}").alias(f"had_{name}") for name in FUNNEL_EVENTS],
        F.sum("page_views").alias("page_views"),
        sum_money("purchases").cast(MONEY).alias("purchases"),
    )


def sessions_from_parts(parts: DataFrame) -> DataFrame:
    """Sessions in the shape of the batch model."""
    return _rolled(parts, [*SESSION_KEY]).select(
        *SESSION_KEY,
        F.col("first.event_timestamp").alias("session_started_at"),
        F.to_date("first.event_timestamp").alias("session_date"),
        F.col("ended_at").alias("session_ended_at"),
        F.col("number").alias("session_number"),
        F.col("first.source").alias("session_source"),
        F.col("first.medium").alias("session_medium"),
        F.col("first.campaign").alias("session_campaign"),
        *[f"had_{name}" for name in FUNNEL_EVENTS],
        F.col("page_views").alias("page_view_count"),
        F.col("purchases").alias("purchase_value"),
    )


def _batch_folders(spark: SparkSession, path: str) -> list[str]:
    """Complete batches. A compaction hides the batches and compactions before it."""
    names = Folder(spark, path).written_folders()
    upto = max((int(n[5:]) for n in names if n.startswith("upto-")), default=-1)
    batches = [n for n in names if n.startswith("batch-") and int(n[6:]) > upto]
    return [f"upto-{upto:012d}", *batches] if upto >= 0 else batches


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """All partials stored at ``path``, or None before the first batch."""
    folders = _batch_folders(spark, path)
    return spark.read.parquet(*[f"{path}/{name}" for name in folders]) if folders else None


def compact_sessions(spark: SparkSession, path: str) -> None:
    """Merge all partials so far into one row per session and day.

    The merged rows count from the moment their folder is complete; only then do the batches in it
    go, so a call that breaks off loses nothing. Don't call it while a batch may be replayed.
    """
    folders = _batch_folders(spark, path)
    batches = [int(name[6:]) for name in folders if name.startswith("batch-")]
    if not batches:
        return
    merged = _rolled(spark.read.parquet(*[f"{path}/{name}" for name in folders]), PART_KEY)
    merged.write.mode("overwrite").parquet(f"{path}/upto-{max(batches):012d}")
    # Also what a call that broke off here has left.
    folder = Folder(spark, path)
    for name in folder.written_folders():
        if int(name.rpartition("-")[2]) <= max(batches) and name != f"upto-{max(batches):012d}":
            folder.remove(name)


def session_stream(staged_events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start folding a stream of staged web events into the partials at ``path``.

    ``path`` and ``checkpoint`` belong together: batches are numbered by the checkpoint.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        session_parts(batch).write.mode("overwrite").parquet(f"{path}/batch-{batch_id:012d}")

    return (
        staged_events.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
