"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents, and each works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontaminate, mixing, simhash, token_store, toxicity
from quire.llm.common import stored, table


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return simhash.keep_first(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a full window of a benchmark item go, and those that shorter items contaminate."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the rows of a repeated document are the same."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row, read back from the files of ids."""
    return token_store.read_tokens(token_store.write_tokens(docs), with_ids=False)


STAGES = [
    ("toxicity", toxic_stage),
    ("simhash near-dedup", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing", mix_stage),
    ("token ids", token_stage),
]

#: SQL has no zstandard, no SimHash trie and no tokenizer; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
