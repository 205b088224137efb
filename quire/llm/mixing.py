"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Every source asks for its share of the budget by weight; a share above the cap (most epochs times the
source's size) is clamped and the excess shared again by weight among the rest. The fixed point of that
is water level L with target = min(cap, L * weight); it is reached here in one pass over the sources in
the order in which they fill up (cap / weight), so no loop over clamping rounds is needed.

Documents are then repeated: whole epochs for all, and the rest of the target by a seeded order. That
order is dealt into buckets; bucket totals say which buckets are taken whole, and only the one bucket in
which a source's quota ends is ordered by itself, so a source of a third of all rows is never sorted in
one task. The document at which the quota ends gives just the words that are missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import WORD_SPLIT, checkpointed, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = 17
PREFIX = "mix_"
BUCKETS = 4096
#: Up to so many sources (under 200 bytes each) the plan is broadcast; beyond that it is joined by shuffling.
MOST_BROADCAST = 50_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_SPLIT)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most_epochs: float = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from rows (source, size): one row for each source, null last.

    The windows below run over one row for each source, not over documents. A source without words has
    target 0; an empty table gives no rows.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    weighed = by_source.withColumn("_w", F.get(w, (F.row_number().over(order) - 1) % len(weights))).withColumn("_cap", F.col("source_size") * float(most_epochs))
    fills = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) * share - F.coalesce(F.sum("_cap").over(fills), F.lit(0.0))) / (
        F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(fills), F.lit(0.0))
    )
    filled = weighed.withColumn("_level", level).withColumn("_full", F.col("_level") >= F.col("_cap") / F.col("_w"))
    water = F.max(F.when(~F.col("_full"), F.col("_level"))).over(every)
    return filled.withColumn("_water", water).select(
        "source", "source_size", F.when(F.col("_full"), F.col("_cap")).otherwise(F.least("_cap", F.col("_water") * F.col("_w"))).alias("target")
    )


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most_epochs: float = MOST_EPOCHS, seed: int = SEED, buckets: int = BUCKETS, size: str | None = None, prefix: str = PREFIX) -> DataFrame:
    """docs with columns mix_size, mix_source_size, mix_target and mix_taken (words taken, repeats counted).

    docs needs doc_id, source and text; if size names a column, that has the words of each row and text isn't needed. Other
    columns pass through; columns of those four names (which begin with prefix) are replaced and, but for size, not read.
    Null text has no words and takes none. Null source is a source of its own, the last. Rows that repeat each count; rows
    with the same doc_id share a place in the order and are told apart by text. Reruns agree, as the order is a seeded
    hash. An empty table gives an empty table.
    """
    n_size, n_source, n_target, n_taken = (prefix + x for x in ("size", "source_size", "target", "taken"))
    words = n_words(F.col("text")) if size is None else F.coalesce(F.col(size), F.lit(0)).cast("long")
    tie = F.xxhash64("doc_id", "text") if "text" in docs.columns else F.xxhash64("doc_id", words)
    draw = F.xxhash64(F.lit(seed), "doc_id")
    rows = docs.withColumns({"__quire_size": words, "__quire_draw": draw, "__quire_bucket": F.pmod(F.shiftrightunsigned(draw, 20), F.lit(buckets)).cast("int"), "__quire_tie": tie})
    rows = rows.drop(n_size, n_source, n_target, n_taken).withColumnRenamed("__quire_size", n_size)
    by_bucket = checkpointed(rows.groupBy("source", "__quire_bucket").agg(F.sum(n_size).alias("n")))
    goal = targets(by_bucket.select("source", F.col("n").alias("size")), weights, share, most_epochs)
    goal = goal.withColumn("__quire_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goal = goal.withColumn("__quire_quota", F.round("target").cast("long") - F.col("__quire_whole") * F.col("source_size"))
    goal = goal.select(F.col("source").alias("__quire_s"), F.col("source_size").alias(n_source), F.col("target").alias(n_target), "__quire_whole", "__quire_quota")
    # Where each source's quota ends: one row for each source. The window runs over at most BUCKETS rows a source.
    run = Window.partitionBy("source").orderBy("__quire_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        by_bucket.withColumn("__quire_before", F.coalesce(F.sum("n").over(run), F.lit(0)))
        .join(goal, F.col("source").eqNullSafe(F.col("__quire_s")))
        .where("__quire_before <= __quire_quota and __quire_quota < __quire_before + n")
        .select(F.col("__quire_s").alias("__quire_e"), F.col("__quire_bucket").alias("__quire_end"), (F.col("__quire_quota") - F.col("__quire_before")).alias("__quire_left"))
    )
    end = F.coalesce("__quire_end", F.when(F.col("__quire_quota") > 0, F.lit(buckets)).otherwise(F.lit(-1)))
    # checkpointed: a row for each source, used by both branches below.
    plan = goal.join(ends, F.col("__quire_s").eqNullSafe(F.col("__quire_e")), "left")
    plan = checkpointed(plan.select("__quire_s", n_source, n_target, "__quire_whole", "__quire_quota", end.alias("__quire_end"), F.coalesce("__quire_left", F.lit(0)).alias("__quire_left")))
    keep = [c for c in rows.columns if c not in ("__quire_draw", "__quire_bucket", "__quire_tie")]
    if plan.count() <= MOST_BROADCAST:
        plan = F.broadcast(plan)
    planned = rows.join(plan, F.col("source").eqNullSafe(F.col("__quire_s")), "inner")
    base = F.col("__quire_whole") * F.col(n_size)
    clear = planned.where("__quire_bucket <> __quire_end").withColumn(n_taken, base + F.when(F.col("__quire_bucket") < F.col("__quire_end"), F.col(n_size)).otherwise(F.lit(0)))
    order = Window.partitionBy("source").orderBy("__quire_draw", "__quire_tie", n_size).rowsBetween(Window.unboundedPreceding, -1)
    last = planned.where("__quire_bucket = __quire_end").withColumn("__quire_before", F.coalesce(F.sum(n_size).over(order), F.lit(0)))
    last = last.withColumn(n_taken, base + F.greatest(F.lit(0), F.least(F.col(n_size), F.col("__quire_left") - F.col("__quire_before"))))
    out = [*keep, n_source, n_target, n_taken]
    return clear.select(*out).unionByName(last.select(*out))


def repeated(mixed: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """The rows of mix() as often as they are taken, without its four columns; a part of a document is its first words.

    Rows of which nothing is taken go, so documents without words (null and empty texts) do; an empty table stays empty.
    """
    n_size, n_taken = F.col(prefix + "size"), F.col(prefix + "taken")
    part = n_taken % n_size
    pieces = F.regexp_extract_all("text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    whole = F.array_repeat(F.col("text"), F.floor(n_taken / n_size).cast("int"))
    texts = F.when(part > 0, F.concat(whole, F.array(F.array_join(F.slice(pieces, F.lit(1), part.cast("int")), "")))).otherwise(whole)
    own = [prefix + x for x in ("size", "source_size", "target", "taken")]
    return mixed.where(n_taken > 0).withColumn("text", F.explode(texts)).drop(*own)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """docs as often as the default mix takes them, with the columns of docs and no others, whatever their names.

    Documents without words go, rows that repeat each count, rows without source are a source; an empty table stays empty.
    """
    return repeated(mix(docs, prefix="__quire_mix_"), "__quire_mix_").select(*docs.columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = checkpointed(docs.select("doc_id", "source", n_words(F.col("text")).alias("words")))
    return mix(sizes, size="words").select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken")
    )


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (SELECT *, CASE k % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w, (source_size * 2)::DOUBLE AS cap FROM s),
l AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER f, 0)) AS level
      FROM w WINDOW f AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN level >= cap / w THEN cap ELSE least(cap, max(CASE WHEN level < cap / w THEN level END) OVER () * w) END AS target FROM l)
SELECT count(*) AS documents, t.source AS source, t.source_size::BIGINT AS source_size, round(t.target, 3) AS target
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY ALL
"""
