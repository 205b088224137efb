"""The corpus build between its steps: selection, gates, dimensions, summaries, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import ordered_hashes


class GateError(ValueError):
    """A step may not run."""


def zipped(results: DataFrame, *columns: str) -> DataFrame:
    """Parallel arrays of a row to rows of records."""
    return results.select(*[c for c in results.columns if c not in columns], F.inline(F.arrays_zip(*columns)))


def selected_works(selection: DataFrame, candidates: DataFrame, audit: DataFrame, replacements: DataFrame | None = None, expected: int | None = None) -> DataFrame:
    """Chosen candidates (id) that the audit has, then replacements with the same columns; their number must be as expected."""
    out = candidates.join(selection.select("id"), "id").join(audit, "id")
    out = out if replacements is None else out.unionByName(replacements)
    if expected is not None and (n := out.count()) != expected:
        raise GateError(f"{n} works are selected, {expected} expected")
    return out


def included(pages: DataFrame, pattern: str, expected: int | None = None, title: str = "title") -> DataFrame:
    """Pages whose title matches, and no other number of them than expected."""
    out = pages.where(F.col(title).rlike(pattern))
    if expected is not None and (n := out.count()) != expected:
        raise GateError(f"{n} pages match, {expected} expected")
    return out


def used_codes(texts: DataFrame, text: str = "text") -> DataFrame:
    """(source_id, code) of the glyph templates in texts."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)\{\{\s*skchar2?\s*\|\s*([0-9A-Za-z]+)"), F.lit(1))
    return texts.select("source_id", F.explode(found).alias("code")).distinct()


def missing_codes(used: DataFrame, table: DataFrame) -> DataFrame:
    return used.join(table.select("code"), "code", "left_anti")


def counted(rows: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """(keys, kinds map): how many rows of each kind, for each key."""
    per = rows.groupBy(*keys, kind).agg(F.count("*").alias("n"))
    return per.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(kind), "n")))).alias("kinds"))


def quarantine(passages: DataFrame) -> DataFrame:
    """What is not citable, with its issues one to a row."""
    return passages.where(~F.col("citable")).select("passage_id", "work_id", F.explode("issues").alias("issue", "n"))


def summaries(passages: DataFrame, text: str = "segment") -> tuple[DataFrame, DataFrame]:
    """One row for each work, and totals summed from these."""
    per = passages.groupBy("work_id").agg(
        F.count("*").alias("passages"), F.count_if("citable").alias("citable"), F.count_if(~F.col("citable")).alias("quarantined"), F.sum(F.length(text)).cast("long").alias("characters"), F.max(F.length(text)).cast("long").alias("longest")
    )
    sums = [F.sum(c).alias(c) for c in ("passages", "citable", "quarantined", "characters")]
    return per, per.agg(*sums, F.max("longest").alias("longest"), F.count("*").alias("works"))


def work_summaries(passages: DataFrame) -> DataFrame:
    """Summaries of each work with a digest of its content hashes in order (work_id, sequence, content_sha256)."""
    digests = ordered_hashes(passages, "work_id", ["sequence"], "content_sha256").select("work_id", F.col("digest").alias("content_digest"))
    return summaries(passages)[0].join(digests, "work_id")


def metadata(works: DataFrame, aliases: DataFrame, sources: DataFrame) -> dict[str, DataFrame]:
    """H2: the tables beside the passages: works, work_targets (a row for each target of a work), aliases, sources and source_pages (a
    row for each page of a source, numbered from 0). works: (id, ..., targets array); sources: (id, ..., pages array of structs)."""
    return {
        "works": works.drop("targets"),
        "work_targets": works.select(F.col("id").alias("work_id"), F.explode("targets").alias("target_work")).distinct(),
        "aliases": aliases.distinct(),
        "sources": sources.drop("pages"),
        "source_pages": sources.select(F.col("id").alias("source_id"), F.posexplode("pages").alias("page_sequence", "p")).select("source_id", "page_sequence", "p.*"),
    }


def citable_only(passages: DataFrame, text: str = "text") -> DataFrame:
    """H4: passages that may be cited and searched; one that is not clean, or empty, stops the build."""
    out = passages.where(F.col("citable") & F.col("searchable"))
    bad = out.where((F.col("quality_status") != "clean") | (F.coalesce(F.length(text), F.lit(0)) == 0))
    if not bad.isEmpty():
        raise GateError(f"{bad.count()} citable passages are not clean or have no text")
    return out


def title_text(title: Column, author: Column, *places: Column) -> Column:
    """H6: what the title side of the index reads: title and author, then volume, section, subsection and speaker."""
    return F.concat(*[F.coalesce(c, F.lit("")) for c in (title, author, *places)])


def gated(status: str, allowed: tuple[str, ...] = ("pass",)) -> None:
    """H1: refuses to go on unless the quality status allows it."""
    if status not in allowed:
        raise GateError(f"the quality status is {status}")


def dimension(rows: DataFrame, columns: list[str]) -> DataFrame:
    """H3: distinct values of columns with an id that depends on the values alone."""
    return rows.select(*columns).distinct().withColumn("dimension_id", F.xxhash64(*columns))


def orphans(rows: DataFrame, dim: DataFrame, columns: list[str]) -> DataFrame:
    """H3: rows whose values a dimension lacks; must be empty."""
    return rows.join(dim.select(*columns), columns, "left_anti")


def reconciled(inserted: DataFrame, expected: int, skipped: DataFrame | None = None, expected_skipped: int = 0) -> None:
    """H8: the numbers that must add up before a build is published."""
    got = inserted.count(), 0 if skipped is None else skipped.count()
    if got != (expected, expected_skipped):
        raise GateError(f"inserted and skipped are {got}, expected {(expected, expected_skipped)}")


def manifest(tables: dict[str, DataFrame], digest: Column | None = None, inputs: DataFrame | None = None) -> dict:
    """H9: rows and an order-free digest of each table; inputs: (path, sha256) of the files they were made of."""
    out = {"inputs": {r.path: r.sha256 for r in inputs.select("path", "sha256").collect()}} if inputs is not None else {}
    for name, df in tables.items():
        own = F.xxhash64(*[F.col(c) for c in df.columns if not df.schema[c].dataType.simpleString().startswith("map")]) if digest is None else digest
        n, x = df.agg(F.count("*"), F.coalesce(F.bit_xor(own), F.lit(0))).first()
        out[name] = {"rows": n, "digest": f"{x & (1 << 64) - 1:016x}"}
    return out
