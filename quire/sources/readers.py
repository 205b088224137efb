"""Sources and sinks: JSON, JSON lines, whole texts, tables; schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_document(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A1: files that are one JSON value each."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A2: one record a line; blank lines are skipped, others must parse."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """A3: (path, text) of files."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256)."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def write_lines(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, one folder for each value of by."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def write_table(df: DataFrame, path: str, by: list[str] | None = None, sort: list[str] | None = None) -> None:
    """Parquet; the commit protocol publishes all files or none. sort: clusters rows, so that their statistics prune."""
    out = df.repartitionByRange(*sort).sortWithinPartitions(*sort) if sort else df
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def required(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, by name; the place of CHECK constraints."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in checks.items()]))
    return df.withColumn("broken", broken).where(F.size("broken") > 0)
