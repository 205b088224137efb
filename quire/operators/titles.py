"""Finding works by title, and putting their pages in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import normalize_title, page_key, title_score


def cache_key(operation, params):
    """A5: the first 20 hex digits of the sha256 of a request's sorted JSON; params is a struct with sorted fields."""
    return F.substr(F.sha2(F.to_json(F.struct(operation.alias("operation"), params.alias("params"))), 256), F.lit(1), F.lit(20))


def discover(queries: DataFrame, titles: DataFrame, most: int = 10) -> DataFrame:
    """(work_id, title, score, place, status) of the best titles found for each work's queries (work_id, query_no, query).

    titles: (query, title). Queries after the first with a score of 100 do not count. Status: 90 and more is a match, 70 and more a candidate.
    """
    got = queries.join(titles, "query")
    got = got.withColumns({"_q": normalize_title(F.col("query")), "_t": normalize_title(F.col("title"))})
    got = got.withColumn("score", title_score(F.col("query"), F.col("title"), F.col("_q"), F.col("_t")))
    stop = got.where("score >= 100").groupBy("work_id").agg(F.min("query_no").alias("_stop"))
    best = got.join(stop, "work_id", "left").where("_stop is null or query_no <= _stop").groupBy("work_id", "title").agg(F.max("score").alias("score"))
    w = Window.partitionBy("work_id").orderBy(F.col("score").desc(), "title")
    top = best.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)
    return top.withColumn("status", F.when(F.col("score") >= 90, "match").when(F.col("score") >= 70, "candidate").otherwise("none"))


def resolved(aliases: DataFrame, wanted: DataFrame, most: int = 1000) -> DataFrame:
    """(name, target): redirects (name, to) followed to their end; a cycle ends at the name before it closes.

    One join for each step. Names that have come to rest are set aside, and what still moves is checkpointed if the session has a
    checkpoint folder, so that steps don't run their predecessors again. A chain of over most steps is an error.
    """
    spark = wanted.sparkSession
    step = aliases.select(F.col("name").alias("_n"), F.col("to").alias("_to"))
    moving = wanted.select("name", F.col("name").alias("target"), F.array("name").alias("_seen")).distinct()
    done: list[DataFrame] = []
    for k in range(most + 1):
        next_ = moving.join(step, F.col("target") == F.col("_n"), "left")
        go = F.col("_to").isNotNull() & ~F.array_contains("_seen", F.col("_to"))
        next_ = next_.withColumn("_go", go).persist()
        done.append(next_.where("not _go").select("name", "target"))
        moving = next_.where("_go").select("name", F.col("_to").alias("target"), F.array_append("_seen", F.col("_to")).alias("_seen"))
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            moving = moving.checkpoint()
        if moving.isEmpty():
            break
        if k == most:
            raise ValueError(f"a chain of redirects has over {most} steps")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.join(wanted.select("name"), "name")


def in_reading_order(pages: DataFrame, title: str = "title") -> DataFrame:
    """Listed pages, each once though continuations of a listing repeat some, in reading order."""
    return pages.groupBy(title).agg(*[F.min(c).alias(c) for c in pages.columns if c != title]).orderBy(page_key(F.col(title)), title)


def batched(rows: DataFrame, order: str, size: int, partition: str | None = None) -> DataFrame:
    """A10: rows numbered in batches of size within partition; without one, in order over all rows, numbered part by part
    and moved on by the rows of earlier parts (one row for each part is added up)."""
    if partition:
        return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(partition).orderBy(order)) - 1) / size))
    parts = rows.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id()).persist()
    counts = parts.groupBy("_part").agg(F.count("*").alias("_c"))
    before = counts.select("_part", F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return parts.withColumn("_own", own).join(F.broadcast(before), "_part").withColumn("batch", F.floor((F.col("_before") + F.col("_own")) / size)).drop("_part", "_own", "_before")


def interleaved(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Each parent (parent_no, title) and then its children (parent_no, child_no, title); a parent with children is not of the corpus."""
    having = children.select("parent_no").distinct().withColumn("_has", F.lit(True))
    top = parents.join(having, "parent_no", "left").select("parent_no", F.lit(0).alias("child_no"), "title", F.col("_has").isNull().alias("include"))
    return top.unionByName(children.select("parent_no", "child_no", "title", F.lit(True).alias("include"))).orderBy("parent_no", "child_no")
