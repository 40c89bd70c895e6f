"""Small helpers shared by the operators: fresh inputs and tables that cut lineage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import Folder, scratch_path

# Paths stored in the block that frees them, if there is one.
_HELD: ContextVar[list[str] | None] = ContextVar("held", default=None)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written once to the shared scratch folder and read back.

    The rows are then fixed: a lost executor makes no task compute them again, and
    every later job reads the same ones. A table that a result still reads stays until the
    cluster clears the folder.
    """
    path = scratch_path(frame.sparkSession, label)
    if (held := _HELD.get()) is not None:
        held.append(path)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def freed_at_end(spark: SparkSession) -> Iterator[None]:
    """Free all that is :func:`stored` in the block when it ends; its results must be written by then."""
    held: list[str] = []
    token = _HELD.set(held)
    try:
        yield
    finally:
        _HELD.reset(token)
        for path in held:
            Folder(spark, path).remove()


def discard(table: DataFrame) -> None:
    """Free the files of a stored table that nothing reads any more."""
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        Folder(table.sparkSession, folder).remove()


def utf8(text: str | Column) -> Column:
    """The bytes of a text; a null text counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column, F.lit("")).cast("binary")


def free_names(frame: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, each with underscores added until the frame has no such column."""
    taken, free = {c.lower() for c in frame.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        free.append(name)
        taken.add(name.lower())
    return free
