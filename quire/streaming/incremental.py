"""Incremental indexing with Structured Streaming. An addition: the batch build is what the corpus build needs; this keeps an index
up to date while documents arrive.

Each micro-batch writes its postings and lengths to a folder named by its number, overwriting what a failed attempt left there, so a
batch counts exactly once. Totals and document frequencies are aggregated when the index is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions.text import LETTER_KEEP
from quire.operators import index


def index_stream(docs: DataFrame, path: str, checkpoint: str, title: str = "title", body: str = "text", keep: str = LETTER_KEEP, **trigger) -> StreamingQuery:
    """Starts indexing a stream of documents (id first) into path; trigger: as of DataStreamWriter.trigger."""

    def write(batch: DataFrame, number: int) -> None:
        sets = index.gram_sets(batch, F.col(title), F.col(body), keep).persist()
        index.exploded(sets).write.mode("overwrite").parquet(f"{path}/postings/batch={number}")
        index.lengths(sets).write.mode("overwrite").parquet(f"{path}/lengths/batch={number}")
        sets.unpersist()

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


class StreamedIndex:
    """What has been indexed so far, with the interface of a stored index."""

    def __init__(self, spark: SparkSession, path: str):
        self.postings = spark.read.parquet(f"{path}/postings").drop("batch")
        self.lengths = spark.read.parquet(f"{path}/lengths").drop("batch")
        self.totals = self.lengths.agg(F.count("*").alias("n_docs"), F.avg("tokens").alias("avg_tokens"))

    def hits(self, grams: list[str]) -> DataFrame:
        return self.postings.where(F.col("gram").isin(*grams)) if grams else self.postings.limit(0)
