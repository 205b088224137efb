"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

A document leaves the refinement as soon as nothing else shares its key, so the full hash is only
computed for texts whose length and prefix meet another's. Survivors of the cheap stages are marked in a
bitmap of fixed size (BITS bits, at most BITS / 64 rows of 16 bytes), which is the only thing that is
broadcast; a false mark costs one needless full hash and never a wrong group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import checkpointed, table

PREFIX = 512
BITS = 1 << 24


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None, prefix: int = PREFIX, bits: int = BITS, digest_all: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for each row of docs.

    text_sha256 is null where refinement ended before the full hash, unless digest_all asks for it there too.

    Null text counts as empty; of equal texts the row of the largest id stays. Rows that repeat an id count
    each in group_size and share one verdict. Null ids never stay beside another id of their group (a group
    of null ids alone keeps null, kept true). An empty table gives an empty table. Columns other than id_col
    and the text are not read.
    """
    body = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.octet_length(body).alias("_len"), F.xxhash64(F.substring(body, 1, prefix)).alias("_prefix"), body.alias("_text")
    )
    # Stage 1 and 2: counts by length and by (length, prefix hash), pre-aggregated before their shuffles.
    slim = checkpointed(rows.select("doc_id", "_len", "_prefix"))
    shared_len = slim.groupBy("_len").agg(F.count("*").alias("n")).where("n > 1").select("_len")
    by_prefix = slim.groupBy("_len", "_prefix").agg(F.count("*").alias("n")).where("n > 1").join(shared_len, "_len", "left_semi")
    slot = F.pmod(F.xxhash64("_len", "_prefix"), F.lit(bits))
    words = (
        by_prefix.select(slot.alias("_slot"))
        .groupBy(F.shiftright("_slot", 6).cast("int").alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_slot & 63 as int))")).alias("_marks"))
    )
    # Stage 3: the full hash of marked rows only.
    marked = F.coalesce(F.expr("(shiftrightunsigned(_marks, cast(_slot & 63 as int)) & 1L) = 1L"), F.lit(False))
    full = (
        rows.withColumn("_slot", slot)
        .withColumn("_word", F.shiftright("_slot", 6).cast("int"))
        .join(F.broadcast(words), "_word", "left")
        .select("doc_id", "_len", marked.alias("_marked"), (F.sha2("_text", 256) if digest_all else F.when(marked, F.sha2("_text", 256))).alias("text_sha256"))
    )
    full = checkpointed(full)
    groups = (
        full.where("_marked")
        .groupBy("_len", "text_sha256")
        .agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
        .where("group_size > 1")
    )
    # Cut off from the aggregate's partitioning, so that the join below has exchanges of its own and a hot group is split.
    groups = checkpointed(groups)
    return full.join(groups, ["_len", "text_sha256"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")), F.lit(False)).alias("kept"),
        "text_sha256",
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), digest_all=True)


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
