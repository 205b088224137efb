"""Registration of queries with their SQL, and table access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Tables of texts, whose rows cost much; below so many bytes they may be one row group, which is one task.
TEXTS = ("documents", "pages")
SMALL = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in TEXTS and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < SMALL:
        return df.repartition(spark.sparkContext.defaultParallelism)
    return df


def spread(rows: DataFrame) -> DataFrame:
    """Small rows of which each makes much work, dealt to all cores: their file is too small to be read by as many tasks."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


class Tables:
    """Reads the tables of a folder by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(sql: str | None = None):
    """Registers a function (spark, t) -> DataFrame by its name; t(name) reads a table. sql: the same for DuckDB."""

    def register(fn):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(spark, Tables(spark, sf_dir))
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# DuckDB's side of the text functions.
NORM = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', '', 'g')".format


def grams_sql(x: str) -> str:
    """Bigrams of a normalized text, repeats included."""
    return f"(CASE WHEN length({x}) = 1 THEN [{x}] ELSE list_transform(list_zip(string_split({x}, '')[1:-2], string_split({x}, '')[2:]), lambda z: z[1] || z[2]) END)"


def gram_set_sql(x: str) -> str:
    return f"list_distinct({grams_sql(x)})"
