"""The inverted index as DataFrames: postings, lengths, statistics; and its use by BM25 with satisfied groups.

An index is three tables: postings (id, tokens, gram, in_title, in_body), lengths (id, tokens) and the corpus totals.
write_index() takes the grams of each text once, stores them beside its length and inverts what it stored. It lays postings out by
ranges of gram; a query's grams are literals of its filter, so that the statistics of row groups skip what has none of them. The tables of a version are written first and named in "current" last. Without a stored
index, the grams of the queries are taken straight from the texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import LETTER_KEEP, bigram_set, normalize_query, once

K1 = 1.2
B = 0.75
TITLE_WEIGHT = 5.0
BODY_WEIGHT = 1.0


def gram_sets(docs: DataFrame, title: Column, body: Column, keep: str = LETTER_KEEP) -> DataFrame:
    """(id, title_grams, body_grams); id is the first column of docs. Texts are normalized; null counts as empty."""
    norm = lambda c: normalize_query(F.coalesce(c, F.lit("")), keep)
    rows = once(docs.select(F.col(docs.columns[0]).alias("id"), title.alias("_title"), body.alias("_body")), _t=norm(F.col("_title")), _b=norm(F.col("_body")))
    return once(rows.select("id", "_t", "_b"), title_grams=bigram_set(F.col("_t")), body_grams=bigram_set(F.col("_b"))).drop("_t", "_b")


def exploded(sets: DataFrame) -> DataFrame:
    """Postings (id, tokens, gram, in_title, in_body), without a shuffle: the grams of the body, and those that only the title has."""
    body = F.transform("body_grams", lambda g: F.struct(g.alias("gram"), F.array_contains("title_grams", g).alias("in_title"), F.lit(True).alias("in_body")))
    rest = F.transform(F.array_except("title_grams", "body_grams"), lambda g: F.struct(g.alias("gram"), F.lit(True).alias("in_title"), F.lit(False).alias("in_body")))
    return sets.select("id", tokens().alias("tokens"), F.explode(F.concat(body, rest)).alias("p")).select("id", "tokens", "p.*")


def tokens() -> Column:
    return (F.size("title_grams") + F.size("body_grams")).cast("long")


def lengths(sets: DataFrame) -> DataFrame:
    return sets.select("id", tokens().alias("tokens"))


def totals(sets: DataFrame) -> DataFrame:
    """One row: (n_docs, avg_tokens). They are of the whole corpus, whatever scope a query has."""
    return lengths(sets).agg(F.count("*").alias("n_docs"), F.avg("tokens").alias("avg_tokens"))


#: Postings that one task sorts and writes, about.
POSTINGS = 4_000_000


def write_index(sets: DataFrame, path: str, partitions: int | None = None) -> None:
    """Writes a version of the index below path and then makes it the current one; a failed attempt leaves the old one current.

    The folder lengths has the grams too: ranges need a pass of their own over the postings, and reading sets is cheaper than making them.
    """
    spark, version = sets.sparkSession, uuid.uuid4().hex
    sets.select("id", tokens().alias("tokens"), "title_grams", "body_grams").write.parquet(f"{path}/{version}/lengths")
    stored = spark.read.parquet(f"{path}/{version}/lengths")
    stored.agg(F.count("*").alias("n_docs"), F.avg("tokens").alias("avg_tokens")).coalesce(1).write.parquet(f"{path}/{version}/totals")
    made = spark.read.parquet(f"{path}/{version}/totals").select(F.col("n_docs") * F.coalesce("avg_tokens", F.lit(0.0))).first()[0]
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(made) // POSTINGS))
    exploded(stored).repartitionByRange(n, "gram", "id").sortWithinPartitions("gram", "id").write.parquet(f"{path}/{version}/postings")
    spark.range(1).select(F.lit(version).alias("version")).coalesce(1).write.mode("overwrite").parquet(f"{path}/current")


class Index:
    """A stored index."""

    def __init__(self, spark: SparkSession, path: str):
        at = f"{path}/{spark.read.parquet(f'{path}/current').first().version}"
        self.postings, self.totals = (spark.read.parquet(f"{at}/{t}") for t in ("postings", "totals"))
        self.lengths = spark.read.parquet(f"{at}/lengths").select("id", "tokens")

    def hits(self, grams: list[str]) -> DataFrame:
        """The postings of grams, which are few: they are those of a question."""
        return self.postings.where(F.col("gram").isin(*grams)) if grams else self.postings.limit(0)


def scan(sets: DataFrame, grams: list[str]) -> DataFrame:
    """(id, tokens, gram, in_title, in_body) of the wanted grams only."""
    wanted = F.array(*[F.lit(g) for g in grams]) if grams else F.array().cast("array<string>")
    found = sets.select(
        "id", tokens().alias("tokens"),
        F.array_intersect("title_grams", wanted).alias("t"), F.array_intersect("body_grams", wanted).alias("b"),
    )
    return found.select("id", "tokens", F.explode(F.array_union("t", "b")).alias("gram"), "t", "b").select(
        "id", "tokens", "gram", F.array_contains("t", F.col("gram")).alias("in_title"), F.array_contains("b", F.col("gram")).alias("in_body")
    )


def grams_of(terms: list[str]) -> list[str]:
    """The distinct bigrams of normalized terms."""
    return list(dict.fromkeys(t[i : i + 2] for t in terms if t for i in range(max(1, len(t) - 1))))


def groups(spark: SparkSession, terms: list[tuple[int, str]], broad: bool = False) -> DataFrame:
    """(query, grp, gram, need) from normalized terms (query number, term): all grams of a term, or any of them if broad."""
    rows = []
    for k, (query, term) in enumerate(terms):
        own = grams_of([term])
        rows += [(query, k, g, 1 if broad else len(own)) for g in own]
    return spark.createDataFrame(rows, "query int, grp int, gram string, need int")


def bm25(hits: DataFrame, totals_: DataFrame, wanted: DataFrame, k1: float = K1, b: float = B, title_weight: float = TITLE_WEIGHT, body_weight: float = BODY_WEIGHT) -> DataFrame:
    """(query, id, rank): negative BM25 of the documents in which a group is satisfied, the better the smaller.

    Only grams of satisfied groups count, once for each satisfied group. Document frequencies, the number of documents and
    their mean length are of the whole corpus.
    """
    df = hits.groupBy("gram").agg(F.count("*").alias("df"))
    stats = df.crossJoin(totals_)  # totals_ is one row
    idf = F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = stats.select("gram", "avg_tokens", F.when(idf <= 0, F.lit(1e-6)).otherwise(idf).alias("idf"))
    tf = F.col("in_title").cast("int") * title_weight + F.col("in_body").cast("int") * body_weight
    part = F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("tokens") / F.col("avg_tokens")))
    parts = hits.join(weights, "gram").select("id", "gram", part.alias("part")).join(wanted, "gram")
    satisfied = parts.groupBy("query", "id", "grp").agg(F.sum("part").alias("part"), F.count("*").alias("have"), F.first("need").alias("need")).where("have >= need")
    return satisfied.groupBy("query", "id").agg((-F.sum("part")).alias("rank"))


def scan_bm25(sets: DataFrame, terms: list[tuple[int, str]], broad: bool = False, k1: float = K1, b: float = B, title_weight: float = TITLE_WEIGHT, body_weight: float = BODY_WEIGHT) -> DataFrame:
    """bm25() without an index, for (query, normalized term) pairs: two scans and no shuffle.

    The first scan aggregates one row (documents, mean length, frequency of each wanted gram), which is broadcast; the second
    scores each document by itself.
    """
    own = {(q, k): list(dict.fromkeys(t[i : i + 2] for i in range(max(1, len(t) - 1)))) for k, (q, t) in enumerate(terms) if t}
    wanted = list(dict.fromkeys(g for grams in own.values() for g in grams))
    if not wanted:
        return sets.limit(0).select(F.lit(0).alias("query"), "id", F.lit(0.0).alias("rank"))
    array = F.array(*map(F.lit, wanted))
    found = once(sets, tokens=F.size("title_grams") + F.size("body_grams"), t=F.array_intersect("title_grams", array), b=F.array_intersect("body_grams", array)).select("id", "tokens", "t", "b")
    in_t, in_b = (lambda g: F.array_contains("t", g)), (lambda g: F.array_contains("b", g))
    counts = [F.count_if(in_t(g) | in_b(g)).alias(f"df{k}") for k, g in enumerate(wanted)]
    stats = found.agg(F.count("*").alias("n_docs"), F.avg("tokens").alias("avg_tokens"), *counts)
    rows = found.where(F.size("t") + F.size("b") > 0).crossJoin(F.broadcast(stats))  # one row

    def part(g: str):
        df = F.col(f"df{wanted.index(g)}")
        idf = F.log((F.col("n_docs") - df + 0.5) / (df + 0.5))
        tf = in_t(g).cast("int") * title_weight + in_b(g).cast("int") * body_weight
        return F.when(idf <= 0, F.lit(1e-6)).otherwise(idf) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("tokens") / F.col("avg_tokens")))

    rows = once(rows, parts=F.array(*[F.when(in_t(g) | in_b(g), part(g)) for g in wanted])).select("id", "parts")
    ranks = []
    for q in dict.fromkeys(q for q, _ in own):
        total = None
        for (other, _), grams in own.items():
            if other == q:
                parts = [F.get("parts", F.lit(wanted.index(g))) for g in grams]
                if broad:
                    one = F.when(F.coalesce(*parts).isNotNull(), sum((F.coalesce(x, F.lit(0.0)) for x in parts[1:]), F.coalesce(parts[0], F.lit(0.0))))
                else:
                    one = sum(parts[1:], parts[0])  # null unless every gram is there
                total = [*(total or []), one]
        ranks.append(F.struct(F.lit(q).alias("query"), F.when(F.coalesce(*total).isNotNull(), -sum((F.coalesce(x, F.lit(0.0)) for x in total[1:]), F.coalesce(total[0], F.lit(0.0)))).alias("rank")))
    return rows.select("id", F.explode(F.array(*ranks)).alias("r")).select("r.query", "id", "r.rank").where("rank is not null")


def top(ranked: DataFrame, k: int) -> DataFrame:
    """The k best of one query, ties by id."""
    return ranked.orderBy("rank", "id").limit(k)
