"""Segmentation, quarantine, corrections and links of passages.

Cutting a text is sequential by nature (each cut depends on the one before), so it is a vectorized Python function over
whole texts; everything around it is DataFrame expressions.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import ISSUES, issue_counts

MOST = 700
LEAST = 220
# Where texts may be cut, and what may close a cut.
FULL_STOPS = "。！？；!?"
PAUSES = "，、：,:"
CLOSERS = "”’」』》】"
PREFIXES = {"core-suwen": "SW", "core-lingshu": "LS", "core-shanghanlun": "SHL", "core-jingui": "JKY", "core-nanjing": "NJ", "core-wenbingtiaobian": "WBTB"}

PATTERNS = [(k, re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", p))) for k, p in ISSUES.items()]


def _ends(text: str, marks: str) -> list[int]:
    """Places right after a mark."""
    return [m.end() for m in re.finditer(f"[{re.escape(marks)}]", text)]


def bounded_cuts(text: str, least: int = LEAST, most: int = MOST) -> list[int]:
    """G1: where the pieces of text end. A piece is at most most long and ends at the last full stop that leaves it least
    long at least, else at such a pause, else at most; closing marks stay with what they close if there is room."""
    out, start, n = [], 0, len(text)
    while n - start > most:
        limit, cut = start + most, 0
        for marks in (FULL_STOPS, PAUSES):
            at = max(text.rfind(c, max(start + least - 2, 0), limit) for c in marks) + 1  # a mark before that is too early even if closed
            if at:
                closed = at + 1 if at < limit and text[at] in CLOSERS else at
                if closed >= start + least:
                    cut = closed
                    break
        start = cut or limit
        out.append(start)
    if start < n or not out:
        out.append(n)
    return out


def sentence_ends(text: str) -> list[int]:
    """Ends of sentences with their closing mark; what follows the last is one more."""
    out = [at + 1 if at < len(text) and text[at] in CLOSERS else at for at in _ends(text, FULL_STOPS)]
    return out if out and out[-1] == len(text) else [*out, len(text)]


#: A character with which any issue begins.
SUSPECT = re.compile("[〔HK滚滾\ufffd\ue000-\uf8ff\U000f0000-\U000ffffd\U00100000-\U0010fffd]")


def issues_of(text: str) -> dict[str, int]:
    if not SUSPECT.search(text):
        return {}
    found = {k: len(p.findall(text)) for k, p in PATTERNS}
    return {k: n for k, n in found.items() if n}


def semantic_pieces(text: str, speaker_type: str | None, least: int = LEAST, most: int = MOST) -> list[tuple[int, int, dict[str, int]]]:
    """Bounded pieces, where what has an issue stays apart. A sentence with issues (in dialogue the whole turn) is
    cut by itself and gives its issues to all its pieces; clean sentences beside each other are cut together."""
    whole = issues_of(text)
    if not whole:
        cuts = bounded_cuts(text, least, most)
        return [(a, b, {}) for a, b in zip([0, *cuts], cuts, strict=False)]
    ends = [len(text)] if speaker_type == "dialogue" else sentence_ends(text)
    runs: list[tuple[int, int, dict[str, int]]] = []
    for start, end in zip([0, *ends], ends, strict=False):
        own = issues_of(text[start:end])
        if runs and not own and not runs[-1][2]:
            runs[-1] = (runs[-1][0], end, {})
        else:
            runs.append((start, end, own))
    out = []
    for start, end, own in runs:
        cuts = bounded_cuts(text[start:end], least, most)
        out += [(start + a, start + b, dict(own)) for a, b in zip([0, *cuts], cuts, strict=False)]
    return out


PLACE = "start:int,end:int,issues:map<string,bigint>"
#: Texts that are Python objects at a time.
TEXTS = 256


def pieces(text: Column, speaker_type: Column | None = None, least: int = LEAST, most: int = MOST, with_text: bool = True) -> Column:
    """Array of pieces of each text, with their own text unless that isn't wanted; null text has none.

    Of a batch only a few texts at a time become Python objects; the rest stays as it came."""
    if not most > least >= 1:
        raise ValueError("most must be above least, and least 1 or more")
    fields = [("start", pa.int32()), ("end", pa.int32()), ("issues", pa.map_(pa.string(), pa.int64())), *([("text", pa.string())] if with_text else [])]
    kind = pa.list_(pa.struct(fields))

    def one(x: str | None, y: str | None) -> list[tuple]:
        return [(a, b, list(i.items()), *([x[a:b]] if with_text else [])) for a, b, i in semantic_pieces(x, y, least, most)] if x is not None else []

    @F.arrow_udf(f"array<struct<{PLACE}{',text:string' if with_text else ''}>>")
    def cut(t: pa.Array, s: pa.Array) -> pa.Array:
        done = []
        for k in range(0, len(t), TEXTS):
            parts = zip(t.slice(k, TEXTS).to_pylist(), s.slice(k, TEXTS).to_pylist(), strict=True)
            done.append(pa.array([one(x, y) for x, y in parts], kind))
        return pa.concat_arrays(done) if done else pa.array([], kind)

    return cut(text, F.lit("") if speaker_type is None else speaker_type)


def segmented(blocks: DataFrame, order: list[str], text: str = "text", least: int = LEAST, most: int = MOST) -> DataFrame:
    """Blocks (work_id, speaker_type, text, ...) to passages with sequence, id, content_sha256, issues and quarantine.

    Pieces without a letter or digit are dropped before they are numbered. sequence runs within a work.
    """
    cut = blocks.withColumn("piece", F.explode(pieces(F.col(text), F.col("speaker_type"), least, most))).drop(text)
    cut = cut.withColumn("segment", F.col("piece.text")).where(F.col("segment").rlike(r"[\p{L}\p{N}]"))
    seq = F.row_number().over(Window.partitionBy("work_id").orderBy(*order, "piece.start"))
    return quarantined(cut.withColumn("sequence", seq).withColumn("inherited", F.col("piece.issues")).drop("piece"), "segment").withColumns(
        {"passage_id": F.concat(work_prefix(F.col("work_id")), F.lit("-"), F.lpad(F.col("sequence").cast("string"), 6, "0")), "content_sha256": content_hash(F.col("segment"))}
    )


def content_hash(text: Column) -> Column:
    """G10."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def quarantined(rows: DataFrame, text: str) -> DataFrame:
    """A passage with issues is neither citable nor searched. A corrected one (correction_ids isn't null) has the issues that
    are found in it; any other has those that it inherited, or else those found. text_search, if there is one, is emptied."""
    found = issue_counts(F.col(text))
    fixed = F.coalesce(F.size("correction_ids") > 0, F.lit(False)) if "correction_ids" in rows.columns else F.lit(False)
    inherited = F.col("inherited") if "inherited" in rows.columns else F.lit(None).cast("map<string,bigint>")
    issues = F.when(~fixed & F.coalesce(F.size(inherited) > 0, F.lit(False)), inherited).otherwise(found)
    out = rows.withColumn("issues", issues).withColumn("quarantined", F.size("issues") > 0)
    if "text_search" in rows.columns:
        out = out.withColumn("text_search", F.when(F.col("quarantined"), F.lit("")).otherwise(F.col("text_search")))
    return out.withColumn("citable", ~F.col("quarantined")).drop("inherited")


def work_prefix(work_id: Column) -> Column:
    """G5."""
    known = F.create_map(*[F.lit(x) for kv in PREFIXES.items() for x in kv])
    other = F.regexp_replace(F.regexp_replace(F.upper(work_id), "[^A-Z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.try_element_at(known, work_id), other)


def linked(rows: DataFrame, partition: list[str], order: list[str], id_col: str, citable: Column) -> DataFrame:
    """Previous and next ids, of all rows and among citable ones; the latter are null on other rows.

    Both citable links look back, one in falling order, so that each frame grows by a row at a time.
    """
    own = F.when(citable, F.col(id_col))
    w = Window.partitionBy(*partition).orderBy(*order, id_col)
    back = Window.partitionBy(*partition).orderBy(*[F.col(c).desc_nulls_last() for c in (*order, id_col)])
    seen = lambda x: F.last(own, ignorenulls=True).over(x.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumns(
        {"previous_id": F.lag(id_col).over(w), "next_id": F.lead(id_col).over(w), "previous_citable_id": F.when(citable, seen(w)), "next_citable_id": F.when(citable, seen(back))}
    )


def corrected(passages: DataFrame, corrections: DataFrame, fields: tuple[str, ...] = ("text",)) -> DataFrame:
    """Literal corrections (passage_id, source_id, correction_id, before, after, expected[, field]) applied in order of their id.

    fields: the columns that may be corrected; corrections without a field are of the first. Adds correction_ids and
    correction_error; the latter is null or says why a correction did not apply (its source differs, or before does not stand
    as often as expected). A passage with an error keeps its text; applied() refuses to go on with one.
    """
    of = F.coalesce("field", F.lit(fields[0])) if "field" in corrections.columns else F.lit(fields[0])
    fix = F.struct("correction_id", "source_id", of.alias("field"), "before", "after", "expected")
    lists = corrections.groupBy("passage_id").agg(F.array_sort(F.collect_list(fix)).alias("fixes"))
    times = lambda text, part: F.coalesce(((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("int"), F.lit(0))
    start = F.struct(*[F.col(f) for f in fields], F.lit(None).cast("string").alias("error"))

    def step(acc: Column, fix: Column) -> Column:
        now = F.coalesce(*[F.when(fix["field"] == f, acc[f]) for f in fields])
        n = times(now, fix["before"])
        error = (
            F.when(acc["error"].isNotNull(), acc["error"])
            .when(~fix["field"].isin(*fields), F.concat(fix["correction_id"], F.lit(": no such field")))
            .when(fix["source_id"] != F.col("source_id"), F.concat(fix["correction_id"], F.lit(": other source")))
            .when(n != fix["expected"], F.concat(fix["correction_id"], F.lit(": found "), n.cast("string"), F.lit(" times")))
        )
        change = lambda f: F.when(error.isNull() & (fix["field"] == f), F.replace(acc[f], fix["before"], fix["after"])).otherwise(acc[f]).alias(f)
        return F.struct(*[change(f) for f in fields], error.alias("error"))

    done = passages.join(lists, "passage_id", "left").withColumn("done", F.when(F.col("fixes").isNotNull(), F.aggregate("fixes", start, step)))
    well = F.col("done.error").isNull()
    new = {f: F.when(well & F.col("fixes").isNotNull(), F.col(f"done.{f}")).otherwise(F.col(f)) for f in fields}
    return done.withColumns(new | {"correction_ids": F.when(well, F.transform("fixes", lambda x: x["correction_id"])), "correction_error": F.col("done.error")}).drop("fixes", "done")


def applied(passages: DataFrame, corrections: DataFrame, fields: tuple[str, ...] = ("text",)) -> DataFrame:
    """G7 as a gate: corrected passages; a correction that fails, or has no passage, stops the build with its name."""
    from quire.operators.build import GateError

    out = corrected(passages, corrections, fields)
    failed = [r[0] for r in out.where("correction_error is not null").select("correction_error").limit(10).collect()]
    lost = [r[0] for r in unapplied(passages, corrections).select("correction_id").limit(10).collect()]
    if failed or lost:
        raise GateError("; ".join([*failed, *(f"{x}: no such passage" for x in lost)]))
    return out


def unapplied(passages: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrections of no passage."""
    return corrections.join(passages.select("passage_id"), "passage_id", "left_anti")


