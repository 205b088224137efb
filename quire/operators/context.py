"""Neighbours, context windows and tables of contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def neighbours(rows: DataFrame, partition: str, order: str, id_col: str) -> DataFrame:
    """Ids of the nearest rows before and after."""
    w = Window.partitionBy(partition).orderBy(order)
    return rows.withColumns({"previous_id": F.lag(id_col).over(w), "next_id": F.lead(id_col).over(w)})


def context(rows: DataFrame, anchors: DataFrame, partition: str, order: str, before: int = 1, after: int = 1) -> DataFrame:
    """For each anchor (partition, order) up to before rows before it, itself and up to after rows after it.

    A positional range join: rows are numbered within their partition, and each row meets the anchors that it can stand beside
    by an equi-join on partition and number. Adds anchor and context_role (before, anchor or after).
    """
    if before < 0 or after < 0:
        raise ValueError("context must not be negative")
    numbered = rows.withColumn("_n", F.row_number().over(Window.partitionBy(partition).orderBy(order)))
    wanted = anchors.select(F.col(partition).alias("_p"), F.col(order).alias("anchor"))
    at = numbered.join(wanted, (F.col(partition) == F.col("_p")) & (F.col(order) == F.col("anchor"))).select("_p", "anchor", F.col("_n").alias("_a"))
    spread = at.withColumn("_k", F.explode(F.sequence(F.col("_a") - before, F.col("_a") + after)))
    role = F.when(F.col("_k") < F.col("_a"), "before").when(F.col("_k") == F.col("_a"), "anchor").otherwise("after")
    return numbered.join(spread, (F.col(partition) == F.col("_p")) & (F.col("_n") == F.col("_k"))).withColumn("context_role", role).drop("_n", "_p", "_a", "_k")


def toc(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """For each heading its first place and number of rows, in reading order."""
    return rows.groupBy(*keys).agg(F.min(order).alias("first"), F.count("*").alias("n")).orderBy("first")
