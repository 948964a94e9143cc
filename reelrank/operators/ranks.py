"""Numbering rows within a group without one task for the group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN = 4096  # consecutive ids numbered together


def numbered(rows: DataFrame, group: list[str], by: str, to: str = "pos", run: int = RUN) -> DataFrame:
    """``rows`` with ``to``, the 0-based place of each row in its ``group`` by the whole number ``by``, distinct within it.

    Numbered in runs of ids and moved by the sizes of the runs before, so a
    group of a third of all rows is not sorted in one task.
    """
    cut = rows.withColumn("run", F.floor(F.col(by) / run))
    sizes = cut.groupBy(*group, "run").agg(F.count(F.lit(1)).alias("n_run"))
    before = sizes.select(*group, "run", F.coalesce(F.sum("n_run").over(
        Window.partitionBy(*group).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_run"))
    place = F.row_number().over(Window.partitionBy(*group, "run").orderBy(by))
    return (cut.withColumn("place", place).join(before, [*group, "run"])
            .withColumn(to, F.col("before_run") + F.col("place") - 1).drop("run", "place", "before_run"))
