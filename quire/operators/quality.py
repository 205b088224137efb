"""Scans, gates and measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import issue_counts
from quire.operators.segment import linked


def nearest_rank(values: Column, fraction: float) -> Column:
    """M8 as an aggregate: sorted[round((n - 1) * fraction)], halves to even, by counts of equal values."""
    ordered = F.array_sort(F.collect_list(values))
    at = F.bround((F.size(ordered) - 1) * F.lit(fraction), 0).cast("int")
    return F.when(F.size(ordered) > 0, F.get(ordered, at))


def nearest_ranks(rows: DataFrame, keys: list[str], value: str, fractions: tuple[float, ...]) -> DataFrame:
    """M8 for groups of any size: running counts of distinct values, so that no group is gathered in one row.

    (keys, fraction, value). Nulls are left out.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    totals = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    w = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = counts.withColumn("_to", F.sum("_c").over(w))
    joined = run.join(totals, keys) if keys else run.crossJoin(totals)
    at = joined.withColumn("fraction", F.explode(F.array(*map(F.lit, fractions)))).withColumn("_at", F.bround((F.col("_n") - 1) * F.col("fraction"), 0).cast("long"))
    return at.where("_to > _at and _to - _c <= _at").select(*keys, "fraction", value)


def passage_scan(rows: DataFrame, text: str, citable: Column, most: int = 700) -> DataFrame:
    """M3's totals: one row of counts over passages (work_id, text)."""
    n = F.length(text)
    issues = issue_counts(F.col(text))
    return rows.agg(
        F.count("*").alias("passages"), F.count_if(citable).alias("citable"), F.count_if(~citable).alias("quarantined"), F.sum(n).cast("long").alias("characters"), F.max(n).cast("long").alias("longest"),
        F.count_if(n == 0).alias("empty"), F.count_if(n > most).alias("too_long"), F.count_if(F.size(issues) > 0).alias("with_issues"), F.count_distinct("work_id").alias("works"),
    )


# What blocks a corpus where it stands in a passage, and what is only counted.
BLOCKING = {
    "unicode-replacement-character": r"\x{fffd}", "residual-wiki-template": r"\{\{|\}\}", "residual-html-or-pseudo-tag": r"(?i)</?(?:篇名|目[录錄]|noinclude|onlyinclude|poem|ref)\b",
    "residual-image-artifact": r"(?i)\\p[^\\\s]*\.bmp|\.bmp\\r", "null-byte": r"\x00", "private-use-character": r"[\x{e000}-\x{f8ff}\x{f0000}-\x{ffffd}\x{100000}-\x{10fffd}]",
}
WARNING = {"known-ui-text-intrusion": r"滚动条|滾動條", "legacy-glyph-placeholder-ht-kt": r"(?<![A-Za-z])(?:HT|KT)(?![A-Za-z])", "explicit-missing-glyph": r"〔(?:未识别字[0-9]+|原文缺字(?::[^〕]+)?|四库缺字[0-9]+)〕", "mojibake-keyword": r"锟斤拷|烫烫烫|屯屯屯"}


def passage_issues(rows: DataFrame, text: str, order: list[str], citable: Column, blocking: dict[str, str] | None = None, warning: dict[str, str] | None = None, examples: int = 3) -> DataFrame:
    """M3: (issue, blocking, n, n_citable, examples) of the patterns that occur: blocking ones by passages, others by occurrences;
    the first passages in order are given as examples, cut at 180 characters."""
    kinds = [(True, k, p) for k, p in (BLOCKING if blocking is None else blocking).items()] + [(False, k, p) for k, p in (WARNING if warning is None else warning).items()]
    hit = lambda b, k, p: F.struct(F.lit(k).alias("issue"), F.lit(b).alias("blocking"), (F.col(text).rlike(p).cast("long") if b else F.regexp_count(text, F.lit(p)).cast("long")).alias("n"))
    hits = F.filter(F.array(*[hit(*x) for x in kinds]), lambda x: x["n"] > 0)
    found = rows.select(F.struct(*order).alias("_o"), F.substring(text, 1, 180).alias("_t"), citable.alias("_citable"), F.explode(hits).alias("x")).select("_o", "_t", "_citable", "x.*")
    totals = found.groupBy("issue", "blocking").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("_citable"), F.col("n")).otherwise(0)).alias("n_citable"))
    first = found.withColumn("_k", F.row_number().over(Window.partitionBy("issue").orderBy("_o"))).where(F.col("_k") <= examples)
    shown = first.groupBy("issue").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_t"))), lambda x: x["_t"]).alias("examples"))
    return totals.join(shown, "issue")


def status_faults(rows: DataFrame, partition: list[str], order: list[str]) -> DataFrame:
    """M3: (fault, n) of passages (id, citable, searchable, quality_status, text_search, flags array, the four link columns)
    whose state contradicts itself, or whose links are not those of their neighbours."""
    links = ("previous_id", "next_id", "previous_citable_id", "next_citable_id")
    true = linked(rows.drop(*links), partition, order, "id", F.col("citable")).select("id", *[F.col(c).alias(f"_{c}") for c in links])
    both = rows.join(true, "id")
    off = lambda c: ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    good, bad = F.col("citable"), ~F.col("citable")
    tests = {
        "invalid-citable-quality-status": good & ((F.col("quality_status") != "clean") | ~F.col("searchable")),
        "invalid-quarantine-status": bad & ((F.col("quality_status") != "quarantined") | F.col("searchable")),
        "quarantine-search-text-leak": bad & (F.coalesce("text_search", F.lit("")) != ""),
        "quarantine-citable-link-leak": bad & (F.col("previous_citable_id").isNotNull() | F.col("next_citable_id").isNotNull()),
        "quarantine-without-disclosed-reason": bad & (F.coalesce(F.size("flags"), F.lit(0)) < 1),
        "broken-passage-links": off("previous_id") | off("next_id"),
        "broken-citable-links": good & (off("previous_citable_id") | off("next_citable_id")),
    }
    one = both.agg(*[F.count_if(F.coalesce(t, F.lit(False))).alias(k) for k, t in tests.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("fault"), F.col(f"`{k}`").alias("n")) for k in tests]))).where("n > 0")


# What is counted in raw pages.
RAW_HEADING = r"(?m)^\s*=+\s*(.*?)\s*=+\s*$"
VOLUME = r"卷(?:第)?(?:[〇零一二三四五六七八九十百千]+|[0-9]+)"
PROOFREAD = r"""(?i)<pagequality\s+level=["']?([0-9])"""


def raw_metrics(pages: DataFrame, most: int = 10, heading: str = RAW_HEADING, volume: str = VOLUME, level: str = PROOFREAD) -> DataFrame:
    """M1: a row for each source of pages (source_id, page_no, title, parent_title, categories array, include, raw, raw_sha256):
    pages whose hash differs (number, and the first titles), characters, headings, distinct volumes, proofreading levels and
    quality categories (maps of how many). All but the first and the last are of included pages."""
    inside = F.coalesce("include", F.lit(False))
    leaf = F.substring_index(F.coalesce("parent_title", "title"), "/", -1)
    wrong = F.sha2("raw", 256) != F.col("raw_sha256")
    per = pages.groupBy("source_id").agg(
        F.count_if(inside).alias("included"), F.count_if(wrong).alias("hash_mismatches"), F.sum(F.when(inside, F.length("raw")).otherwise(0)).cast("long").alias("characters"),
        F.sum(F.when(inside, F.regexp_count("raw", F.lit(heading))).otherwise(0)).cast("long").alias("headings"), F.count_distinct(F.when(inside & leaf.rlike(volume), leaf)).alias("volumes"),
    )
    first = pages.where(wrong).withColumn("_k", F.row_number().over(Window.partitionBy("source_id").orderBy("page_no"))).where(F.col("_k") <= most)
    titles = first.groupBy("source_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "title"))), lambda x: x["title"]).alias("mismatch_titles"))

    def histogram(rows: DataFrame, values: Column, name: str) -> DataFrame:
        counts = rows.select("source_id", F.explode(values).alias("k")).groupBy("source_id", "k").agg(F.count("*").alias("n"))
        return counts.groupBy("source_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias(name))

    levels = histogram(pages.where(inside), F.regexp_extract_all("raw", F.lit(level), F.lit(1)), "levels")
    share = F.array_compact(F.transform("categories", lambda c: F.when(c.rlike("^Category:(25|50|75)%$"), F.regexp_extract(c, "([0-9]+%)", 1))))
    return per.join(titles, "source_id", "left").join(levels, "source_id", "left").join(histogram(pages, share, "categories"), "source_id", "left")


def structure(metrics: DataFrame, expected: DataFrame) -> DataFrame:
    """M2: (source_id, kind, minimum_accepted, observed, status) from raw_metrics and expected (source_id, kind, minimum_accepted); a
    source of which nothing is expected must have one included page."""
    both = metrics.join(expected, "source_id", "left")
    observed = F.when(F.col("kind").isNull(), F.col("included")).when(F.col("kind") == "volume", F.col("volumes")).otherwise(F.col("headings"))
    least = F.coalesce("minimum_accepted", F.lit(1))
    return both.select("source_id", F.coalesce("kind", F.lit("nonempty-corpus")).alias("kind"), least.alias("minimum_accepted"), observed.alias("observed"), F.when(observed >= least, "pass").otherwise("fail").alias("status"))


def upstream_blocks(metrics: DataFrame, layers: DataFrame) -> DataFrame:
    """M5: (source_id, reasons array) from raw_metrics and (source_id, layer)."""
    many = lambda c, *keys: sum((F.coalesce(F.try_element_at(c, F.lit(k)), F.lit(0)) for k in keys), F.lit(0))
    low, bad = many("categories", "25%", "50%"), many("levels", "0", "1")
    reasons = F.array_compact(
        F.array(
            F.when((F.col("layer") == "core") & (low > 0), "core source has upstream 25%/50% quality category and lacks completed second-base collation"),
            F.when(bad > 0, F.concat(F.lit("ProofreadPage contains "), bad.cast("string"), F.lit(" unproofread/problem pages"))),
        )
    )
    return metrics.join(layers, "source_id").select("source_id", reasons.alias("reasons"))


def source_lock(inventory: DataFrame, reasons: DataFrame, complete: DataFrame, processed: DataFrame) -> DataFrame:
    """M7: inventory (source_id, ...) with reasons (source_id, reasons array), complete (source_id, status) and processed (source_id,
    passages): lock_status is final for a source that is complete, processed and without a reason, else candidate-blocked."""
    out = inventory.join(reasons, "source_id", "left").join(complete.withColumnRenamed("status", "completeness"), "source_id", "left").join(processed, "source_id", "left")
    out = out.withColumns({"reasons": F.coalesce("reasons", F.array().cast("array<string>")), "passages": F.coalesce("passages", F.lit(0)), "completeness": F.coalesce("completeness", F.lit("missing"))})
    final = (F.size("reasons") == 0) & (F.col("completeness") == "pass") & (F.col("passages") > 0)
    return out.withColumn("lock_status", F.when(final, "final").otherwise("candidate-blocked"))


def duplicates(rows: DataFrame, key: Column) -> DataFrame:
    """Groups of the same key with more than one row: (key, n)."""
    return rows.groupBy(key.alias("key")).agg(F.count("*").alias("n")).where("n > 1")


def broken_links(rows: DataFrame, partition: str, order: str, id_col: str, previous: str) -> DataFrame:
    """Rows whose previous id is not that of the row before."""
    w = Window.partitionBy(partition).orderBy(order)
    return rows.withColumn("_b", F.lag(id_col).over(w)).where(~F.col("_b").eqNullSafe(F.col(previous))).drop("_b")


def gate(checks: DataFrame) -> DataFrame:
    """M6: (name, passed, blocking) checks to one row: status and the reasons against."""
    return checks.agg(
        F.when(F.bool_and(F.col("passed")), "pass").when(F.bool_and(F.col("passed") | ~F.col("blocking")), "pass-with-warnings").otherwise("blocked").alias("status"),
        F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("name")))).alias("reasons"),
    )


def ratios(rows: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """The share of rows that pass each test, null tests left out, to six places."""
    return rows.agg(*[F.round(F.avg(c.cast("double")), 6).alias(k) for k, c in tests.items()])


# What an acceptance run must reach.
THRESHOLDS = {"recall_at_5": 0.97, "level": 0.95, "author": 0.90, "safety": 1.0}


def recall_at(expected: DataFrame, results: DataFrame, k: int = 5) -> DataFrame:
    """(n, found, recall): the share of expected (query_id, id) queries of which an expected id is among the first k results
    (query_id, place from 1, id)."""
    asked = expected.select("query_id").distinct()
    hit = results.where(F.col("place") <= k).join(expected, ["query_id", "id"], "left_semi").select("query_id").distinct().withColumn("hit", F.lit(1))
    return asked.join(hit, "query_id", "left").agg(F.count("*").alias("n"), F.count("hit").alias("found"), F.round(F.avg(F.coalesce("hit", F.lit(0)).cast("double")), 6).alias("recall"))


def accepted(measures: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Measures (name, value) against thresholds: (name, value, threshold, passed). One that is missing, or null, fails."""
    asked = measures.sparkSession.createDataFrame(list((thresholds or THRESHOLDS).items()), "name string, threshold double")
    return asked.join(measures, "name", "left").withColumn("passed", F.coalesce(F.col("value") >= F.col("threshold"), F.lit(False)))
