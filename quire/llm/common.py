"""Helpers shared by the corpus operators: shared storage, Arrow batches, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.shared import application_dir, shared_dir

WORD_SPLIT = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """df written to the shared folder and read again: cuts lineage and outlives executors."""
    spark = df.sparkSession
    path = f"{application_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions_for(df: DataFrame, each: int = 64 << 20) -> int:
    """spark.sql.shuffle.partitions, or more if the optimizer's estimate of df comes to over each bytes a partition."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, -(-size // each)) if size < 1 << 60 else least  # beyond that, the size isn't known


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that applies fn to each batch that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return run


def worker_kept(name: str, make: Callable):
    """What make() gives, made once in a Python worker and kept from task to task."""
    import sys
    import types

    held = sys.modules.setdefault("__quire_worker__", types.ModuleType("__quire_worker__")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = 200_000) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by keys; up to most rows, unless one group is larger."""
    import numpy as np

    held: list[pa.RecordBatch] = []
    rows = 0

    def cut(t: pa.Table) -> int:
        n = t.num_rows
        if n < 2:
            return 0
        new = np.zeros(n - 1, bool)
        for k in keys:
            c = t.column(k).combine_chunks()
            new |= np.asarray(c.slice(1)) != np.asarray(c.slice(0, n - 1))
        at = np.flatnonzero(new)
        return int(at[-1]) + 1 if len(at) else 0

    target = most
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < target:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        if k := cut(t):
            yield t.slice(0, k)
            t = t.slice(k)
            target = most
        else:
            target = rows * 2
        held, rows = t.to_batches(), t.num_rows
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    pairs = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return pairs.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Distributed union-find by alternating large and small stars.

    edges: (a long, b long), repeats, loops and either direction allowed; null ends are dropped.
    Returns (node long, root long) with one row for each node that an edge joins to another;
    root is the least node of its component. No component meets in one task: each round only
    takes minima of keys and joins them back, and is checkpointed.
    """
    now = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct()
    now = checkpointed(now)
    seen = None
    for _ in range(most_rounds):
        now = checkpointed(_small_star(_large_star(now)))
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
