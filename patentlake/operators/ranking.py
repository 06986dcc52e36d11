"""Places in one order over all rows, without a task that sees them all.

Rows are dealt to tasks in ranges of the order and written with their place within the
task's range; how many rows lie in the ranges before, one number for each range, is added
to it. Only those counts are ever in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patentlake.sources.shared import shared_folder

_IN_TASK = 33  # bits of monotonically_increasing_id below the task's number


def stored(rows: DataFrame, name: str) -> DataFrame:
    """rows written once to the shared folder and read from there, so that what is numbered stays numbered."""
    path = shared_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def with_place(rows: DataFrame, row: str, within: Sequence[str] = (), name: str = "place") -> DataFrame:
    """1-based place of each stored row, given its monotonically increasing id in the column `row`.

    Rows of a task and of equal `within` must lie next to each other and have ids without
    gaps. Counted over all, or within the first of those columns in the order of the others.
    """
    by = list(within) or ["_task"]
    numbered = rows.withColumn("_task", F.shiftright(row, _IN_TASK))
    parts = numbered.groupBy(*by).agg(F.min(row).alias("_first"), F.count("*").alias("_n"))
    order = Window.orderBy("_task") if not within else Window.partitionBy(within[0]).orderBy(*within[1:])
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumn("_before", before).drop("_n")
    return numbered.join(parts, by).withColumn(name, F.col(row) - F.col("_first") + F.col("_before") + 1).select(*rows.columns, name)


def ranked(rows: DataFrame, order: Sequence[Column | str], name: str = "place") -> DataFrame:
    """rows with their place in `order`, from 1 on; equal ones get places in any order. An empty table stays empty."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    return with_place(stored(dealt, "ranked"), "_row", name=name).drop("_row")


def page(rows: DataFrame, order: Sequence[Column | str], start: int = 1, count: int | None = None) -> DataFrame:
    """Rows from 1-based `start` on, at most `count`; none if that is past the end."""
    placed = ranked(rows, order, "_place").where(F.col("_place") >= start)
    return (placed if count is None else placed.where(F.col("_place") < max(start, 1) + count)).drop("_place")
