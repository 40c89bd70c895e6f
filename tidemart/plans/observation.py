"""Row rules counted while tables are written, so that no check scans them afterwards.

Each write of the build carries the null, vocabulary and range counts of its table. They stand
above every shuffle of the write, where a task's counts are taken once, when it ends. A raw feed is
counted by the write of the table that is staged from it, or of the one mart that reads it as it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

from tidemart.functions.columns import count_if
from tidemart.plans import quality
from tidemart.plans.quality import Rule


class Observed:
    """Failing rows per rule of the tables that were written while being watched."""

    def __init__(self, rules: Mapping[str, Sequence[Rule]] | None = None) -> None:
        self._rules = dict(quality.row_rules() if rules is None else rules)
        self._taken: dict[str, tuple[Observation, DataFrame]] = {}

    def _of(self, table: str) -> list[tuple[str, Rule]]:
        """The rules of a table with the names of their counts."""
        numbered = ((f"{check}:{i}", r) for check, rules in self._rules.items() for i, r in enumerate(rules))
        return [(name, rule) for name, rule in numbered if rule[0] == table]

    def watches(self, table: str) -> bool:
        """Whether there are rules of a table."""
        return bool(self._of(table))

    def watching(self, table: str, rows: DataFrame) -> DataFrame:
        """``rows`` whose next write or read counts what breaks the rules of ``table``."""
        counts = [count_if(condition).alias(name) for name, (_, _, condition) in self._of(table)]
        if not counts:
            return rows
        observation = Observation(f"rules of {table}")
        self._taken[table] = observation, rows
        return rows.observe(observation, *counts)

    def _counts(self, table: str) -> dict[str, int]:
        """The counts taken; where a plan turned out to be empty there are none, and its rows are counted."""
        observation, rows = self._taken[table]
        try:
            return observation.get
        except Py4JJavaError:
            counts = [count_if(condition).alias(name) for name, (_, _, condition) in self._of(table)]
            return rows.agg(*counts).first().asDict()

    def failures(self, spark: SparkSession, check: str) -> DataFrame:
        """``(table_name, column_name, failures, status)`` of a check, one row per rule; reads no table.

        A table that was not written while watched raises, so that no rule passes unseen.
        """
        missing = {table for table, _, _ in self._rules[check]} - self._taken.keys()
        if missing:
            raise ValueError(f"{', '.join(sorted(missing))}: not watched while written")
        counts = {table: self._counts(table) for table in dict.fromkeys(t for t, _, _ in self._rules[check])}
        rows = [(table, column, counts[table][f"{check}:{i}"]) for i, (table, column, _) in enumerate(self._rules[check])]
        schema = "table_name string, column_name string, failures bigint"
        return quality.with_status(spark.createDataFrame(rows, schema))
