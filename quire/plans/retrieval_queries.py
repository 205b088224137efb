"""Queries of retrieval: BM25, scope, semi and anti joins, coverage, caps, windows, choice."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import context, index, packet, quality, rank, retrieve, segment
from quire.plans.base import NORM, gram_set_sql, query
from quire.sources import shared

TERMS = ["thereon", "quality", "aller", "cióndo"]
TITLE = "(lang || ' ' || source)"


def _sets(t):
    d = t("documents").select("doc_id", "text", F.concat_ws(" ", "lang", "source").alias("title"))
    return index.gram_sets(d, F.col("title"), F.col("text"))


def _grams(term: str) -> list[str]:
    return list(dict.fromkeys(term[i : i + 2] for i in range(len(term) - 1)))


def _ranked(spark, t, broad: bool):
    return index.scan_bm25(_sets(t), [(0, x) for x in TERMS], broad)


def _bm25_sql(broad: bool, k: int | None) -> str:
    rows = ", ".join(f"({n}, '{g}', {1 if broad else len(_grams(x))})" for n, x in enumerate(TERMS) for g in _grams(x))
    return f"""WITH q(grp, gram, need) AS (VALUES {rows}),
s AS MATERIALIZED (SELECT doc_id AS id, {gram_set_sql('t')} AS tg, {gram_set_sql('b')} AS bg FROM (SELECT doc_id, {NORM(TITLE)} AS t, {NORM('text')} AS b FROM documents)),
st AS (SELECT count(*) AS n_docs, avg(len(tg) + len(bg)) AS avgdl FROM s),
p AS (SELECT id, len(tg) + len(bg) AS tokens, gram, list_contains(tg, gram)::INT * 5.0 + list_contains(bg, gram)::INT * 1.0 AS tf FROM s, (SELECT DISTINCT gram FROM q) WHERE list_contains(tg, gram) OR list_contains(bg, gram)),
df AS (SELECT gram, count(*) AS df FROM p GROUP BY gram),
i AS (SELECT gram, CASE WHEN ln((n_docs - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n_docs - df + 0.5) / (df + 0.5)) END AS idf, avgdl FROM df, st),
c AS (SELECT id, grp, need, idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * tokens / avgdl)) AS part FROM p JOIN i USING (gram) JOIN q USING (gram)),
g AS (SELECT id, grp, sum(part) AS part FROM c GROUP BY id, grp, need HAVING count(*) >= need)
SELECT id AS doc_id, round(-sum(part), 6)::DOUBLE AS rank FROM g GROUP BY id""" + (f" ORDER BY round(-sum(part), 6), id LIMIT {k}" if k else "")


@query(_bm25_sql(False, 50))
def bm25_topk(spark, t):
    """Strict groups, the best 50."""
    out = _ranked(spark, t, False).select(F.col("id").alias("doc_id"), F.round("rank", 6).alias("rank"))
    return out.orderBy("rank", "doc_id").limit(50)


@query(_bm25_sql(True, None))
def bm25_broad(spark, t):
    """J1 with any gram of a term, all matches."""
    return _ranked(spark, t, True).select(F.col("id").alias("doc_id"), F.round("rank", 6).alias("rank"))


_INDEXES: dict[tuple[str, str], str] = {}


def stored_index(spark, t) -> index.Index:
    """The index of a folder's documents; built once in an application and then only read."""
    key = (spark.sparkContext.applicationId, t.sf_dir)
    if key not in _INDEXES:
        path = f"{shared.application_dir(spark)}/index-{uuid.uuid4().hex[:12]}"
        index.write_index(_sets(t), path)
        _INDEXES[key] = path
    return index.Index(spark, _INDEXES[key])


def _asked(spark, t, broad: bool):
    stored = stored_index(spark, t)
    return index.bm25(stored.hits(index.grams_of(TERMS)), stored.totals, index.groups(spark, [(0, x) for x in TERMS], broad))


@query(_bm25_sql(False, 50))
def stored_index_topk(spark, t):
    """The same question to the stored index, which is asked for its grams alone."""
    out = _asked(spark, t, False).select(F.col("id").alias("doc_id"), F.round("rank", 6).alias("rank"))
    return out.orderBy("rank", "doc_id").limit(50)


@query(_bm25_sql(True, None))
def stored_index_broad(spark, t):
    """J1 over the stored index with any gram of a term, all matches."""
    return _asked(spark, t, True).select(F.col("id").alias("doc_id"), F.round("rank", 6).alias("rank"))


_SETS_SQL = f"s AS MATERIALIZED (SELECT doc_id AS id, {gram_set_sql('t')} AS tg, {gram_set_sql('b')} AS bg FROM (SELECT doc_id, {NORM(TITLE)} AS t, {NORM('text')} AS b FROM documents))"


@query(f"WITH {_SETS_SQL}, p AS (SELECT id, unnest(list_distinct(list_concat(tg, bg))) AS gram FROM s) SELECT gram, count(*)::BIGINT AS df FROM p GROUP BY gram")
def stored_postings(spark, t):
    """H7: document frequencies as the stored index has them."""
    return stored_index(spark, t).postings.groupBy("gram").agg(F.count("*").alias("df"))


@query(f"WITH {_SETS_SQL} SELECT count(*)::BIGINT AS n_docs, round(avg(len(tg) + len(bg)), 6)::DOUBLE AS avg_tokens FROM s")
def index_totals(spark, t):
    """H7: the totals of the stored index."""
    return stored_index(spark, t).totals.select("n_docs", F.round("avg_tokens", 6).alias("avg_tokens"))


@query("""SELECT doc_id, lang, source FROM documents WHERE lang IN ('en', 'de') AND source IN ('src0', 'src1', 'src2') AND source NOT IN ('src2') AND contains(source, 'src')""")
def scope_filters(spark, t):
    """One predicate of canon, layer, work, exclusion and author rules."""
    works = t("documents").select("doc_id", "lang", "source").withColumns({"id": F.col("source"), "canon": F.col("lang"), "layer": F.lit("core"), "author": F.col("source"), "targets": F.array("lang")})
    route = retrieve.Route(canons=("en", "de"), work_ids=("src0", "src1", "src2"), excluded_work_ids=("src2",))
    return works.where(retrieve.work_filter(route, retrieve.Scope(layers=("core",), author="src"))).select("doc_id", "lang", "source")


@query("SELECT c_custkey, c_mktsegment FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus IN ('F'))")
def semi_join_exists(spark, t):
    """J5."""
    return t("customer").join(t("orders").where("o_orderstatus in ('F')"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


@query("SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity >= 45)")
def anti_exclude(spark, t):
    """Parts of which no large line was returned."""
    return t("part").join(t("lineitem").where("l_returnflag = 'R' and l_quantity >= 45"), F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey", "p_name")


@query("""SELECT l_orderkey, l_linenumber, n_name, r_name, round(l_extendedprice * (1 - l_discount), 4)::DOUBLE AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus <> 'P' ORDER BY revenue DESC, l_orderkey, l_linenumber LIMIT 240""")
def star_join_topk(spark, t):
    """J1's join shape: facts to four dimensions, filtered before the limit."""
    rows = t("lineitem").join(t("orders").where("o_orderstatus <> 'P'"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select("l_orderkey", "l_linenumber", "n_name", "r_name", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("revenue"))
    return rows.orderBy(F.col("revenue").desc(), "l_orderkey", "l_linenumber").limit(240)


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def candidate_union(spark, t):
    """The second channel adds only what the first lacks."""
    o = t("orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus", "o_orderpriority")
    both = retrieve.merged(o.where("o_orderstatus = 'F'"), o.where("o_orderpriority = '1-URGENT'"))
    return both.select(F.col("id").alias("o_orderkey"), "o_orderstatus")


def _coverage_sql(term: str, k: int) -> str:
    grams = "[" + ", ".join(f"'{g}'" for g in _grams(term)) + "]"
    return f"SELECT doc_id, {k} AS k, '{term}' AS term, contains(b, '{term}') AS eb, contains(t, '{term}') AS ep, greatest(len(list_intersect(bg, {grams})), len(list_intersect(tg, {grams}))) / {len(_grams(term))}.0 AS cov, len(list_intersect(list_distinct(list_concat(bg, tg)), {grams})) AS matched FROM s"


_BEST_SQL = f"""WITH s AS MATERIALIZED (SELECT doc_id, b, t, {gram_set_sql('b')} AS bg, {gram_set_sql('t')} AS tg FROM (SELECT doc_id, {NORM('text')} AS b, {NORM(TITLE)} AS t FROM documents)),
c AS ({' UNION ALL '.join(_coverage_sql(x, k) for k, x in enumerate(TERMS))}),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY eb DESC, ep DESC, cov DESC, length(term) DESC, k) AS n FROM c)
SELECT doc_id, term, eb AS exact_body, round(cov, 6)::DOUBLE AS coverage, matched::BIGINT AS matched, CASE WHEN eb THEN 'A' WHEN ep OR cov >= 0.82 THEN 'B' WHEN cov >= 0.52 AND matched >= 2 THEN 'C' ELSE 'D' END AS tier FROM r WHERE n = 1"""


@query(_BEST_SQL)
def term_coverage_tier(spark, t):
    """K3 and K4 of every document."""
    rows = t("documents").select("doc_id", F.lit("").alias("work_id"), F.lit(0).alias("sequence"), F.lit("core").alias("layer"), F.concat_ws(" ", "lang", "source").alias("place"), "text", F.lit(0.0).alias("rank"), F.col("doc_id").alias("id"))
    out = rank.scored(rows, TERMS)
    return out.select("doc_id", F.col("best.term").alias("term"), F.col("best.exact_body").alias("exact_body"), F.round("best.coverage", 6).alias("coverage"), F.col("best.matched").cast("long").alias("matched"), "tier")


@query(f"""WITH x AS ({_BEST_SQL.replace('SELECT doc_id, term, eb AS exact_body', 'SELECT doc_id, length(term) AS lt, eb AS exact_body')}), d AS (SELECT doc_id, length(text) AS n, length({NORM('text')}) AS clean FROM documents)
SELECT doc_id, round(CASE tier WHEN 'A' THEN 80 WHEN 'B' THEN 46 WHEN 'C' THEN 22 ELSE 0 END + coverage * 18 + CASE WHEN exact_body THEN least(lt, 16) ELSE 0 END + 3.5
 + CASE WHEN n BETWEEN 30 AND 360 THEN 4 WHEN n < 10 THEN -18 WHEN n < 20 THEN -7 WHEN n > 520 THEN -3 ELSE 0 END - CASE WHEN clean < 8 THEN 100 ELSE 0 END, 4)::DOUBLE AS score, tier IN ('A', 'B', 'C') AND clean >= 8 AS useful FROM x JOIN d USING (doc_id)""")
def rescored(spark, t):
    """K5 and K6 without rank: the score formula and the usefulness gate."""
    rows = t("documents").select("doc_id", F.lit("").alias("work_id"), F.lit(0).alias("sequence"), F.lit("core").alias("layer"), F.concat_ws(" ", "lang", "source").alias("place"), "text", F.lit(0.0).alias("rank"), F.col("doc_id").alias("id"))
    out = rank.scored(rows, TERMS)
    # The excerpted oracle rounds coverage to six places; so does this.
    return out.select("doc_id", F.round(F.col("score") - F.col("best.coverage") * 18 + F.round("best.coverage", 6) * 18, 4).alias("score"), "useful")


@query(f"""WITH s AS (SELECT doc_id, source, {gram_set_sql(NORM('text'))} AS g FROM documents), p AS (SELECT doc_id, g, lag(doc_id) OVER w AS before, lag(g) OVER w AS h FROM s WINDOW w AS (PARTITION BY source ORDER BY doc_id))
SELECT doc_id, before, CASE WHEN len(g) = 0 OR len(h) = 0 THEN 0.0 ELSE round(len(list_intersect(g, h)) / (len(g) + len(h) - len(list_intersect(g, h))), 6) END::DOUBLE AS jaccard FROM p WHERE before IS NOT NULL""")
def jaccard_neighbours(spark, t):
    """K1 of each document with the one before it in its source. The window orders ids alone; the gram sets meet by a join."""
    d = t("documents")
    pairs = d.select("doc_id", F.lag("doc_id").over(Window.partitionBy("source").orderBy("doc_id")).alias("before")).where("before is not null")
    s = d.select("doc_id", X.bigram_set(X.normalize_query(F.col("text"), X.LETTER_KEEP)).alias("g"))
    p = pairs.join(s, "doc_id").join(s.select(F.col("doc_id").alias("before"), F.col("g").alias("h")), "before")
    return p.select("doc_id", "before", F.round(X.jaccard(F.col("g"), F.col("h")), 6).alias("jaccard"))


@query("""SELECT c_mktsegment, o_orderkey, place::BIGINT AS place FROM (SELECT c_mktsegment, o_orderkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders JOIN customer ON o_custkey = c_custkey) WHERE place <= 4""")
def per_group_topk_caps(spark, t):
    """K13's caps: the best four of each group."""
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rank.capped(rows, ["c_mktsegment"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 4).select("c_mktsegment", "o_orderkey", F.col("place").cast("long").alias("place"))


@query("""WITH n AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations), a AS (SELECT conv_id, turn AS anchor, k AS ak FROM n)
SELECT n.conv_id, anchor, turn, CASE WHEN k < ak THEN 'before' WHEN k = ak THEN 'anchor' ELSE 'after' END AS context_role, md5(text) AS digest FROM n JOIN a ON n.conv_id = a.conv_id AND k BETWEEN ak - 2 AND ak + 1""")
def context_window(spark, t):
    """Two turns before and one after every turn."""
    c = t("conversations")
    out = context.context(c, c, "conv_id", "turn", 2, 1)
    return out.select("conv_id", "anchor", "turn", "context_role", F.md5("text").alias("digest"))


@query("SELECT conv_id, turn, lag(turn) OVER w AS previous_id, lead(turn) OVER w AS next_id FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def neighbour_links(spark, t):
    """J13."""
    return context.neighbours(t("conversations"), "conv_id", "turn", "turn").select("conv_id", "turn", "previous_id", "next_id")


@query("""WITH d AS (SELECT doc_id, source, coalesce(quality = 1, false) AS citable FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, lag(doc_id) OVER w AS previous_id, lead(doc_id) OVER w AS next_id, CASE WHEN citable THEN last_value(CASE WHEN citable THEN doc_id END IGNORE NULLS) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS previous_citable_id,
CASE WHEN citable THEN first_value(CASE WHEN citable THEN doc_id END IGNORE NULLS) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) END AS next_citable_id FROM d WINDOW w AS (PARTITION BY source ORDER BY doc_id)""")
def citable_links(spark, t):
    """Links among all rows, and among citable ones."""
    rows = t("documents").select("doc_id", "source").join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    out = segment.linked(rows, ["source"], ["doc_id"], "doc_id", F.coalesce(F.col("quality") == 1, F.lit(False)))
    return out.select("doc_id", "previous_id", "next_id", "previous_citable_id", "next_citable_id")


@query("SELECT lang, source, min(doc_id) AS first, count(*)::BIGINT AS n FROM documents GROUP BY lang, source")
def toc_groups(spark, t):
    """J15."""
    return context.toc(t("documents"), ["lang", "source"], "doc_id")


@query("""WITH RECURSIVE n AS (SELECT conv_id, turn, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
r(conv_id, k, used, kept) AS (SELECT DISTINCT conv_id, 0::BIGINT, 0::BIGINT, 0::BIGINT FROM n UNION ALL SELECT r.conv_id, n.k, CASE WHEN used + size <= 500 THEN used + size ELSE used END, CASE WHEN used + size <= 500 THEN kept + 1 ELSE kept END FROM r JOIN n ON r.conv_id = n.conv_id AND n.k = r.k + 1)
SELECT conv_id, max(used)::BIGINT AS used, max(kept)::BIGINT AS kept FROM r GROUP BY conv_id""")
def budget_fit(spark, t):
    """What of each conversation fits in 500 characters; what does not is skipped."""
    items = F.array_sort(F.collect_list(F.struct("turn", F.length("text").cast("long").alias("size"))))
    fit = packet.fit_budget(F.col("items"), lambda x: x["size"], 500)
    return t("conversations").groupBy("conv_id").agg(items.alias("items")).select("conv_id", fit.alias("f")).select("conv_id", F.col("f.used").alias("used"), F.size("f.kept").cast("long").alias("kept"))


def _pool(spark, t):
    """Candidates of one query for each term, from the stored index, with their scores; only their texts are read."""
    stored = stored_index(spark, t)
    ranked = index.bm25(stored.hits(index.grams_of(TERMS)), stored.totals, index.groups(spark, list(enumerate(TERMS))))
    top = rank.capped(ranked, ["query"], [F.col("rank"), F.col("id")], 240).drop("place")
    # top is 240 rows a term; without the hint, all texts would be dealt out by id before its size is known.
    rows = F.broadcast(top).join(t("documents").withColumnRenamed("doc_id", "id"), "id").select(
        "query", F.col("id"), F.col("source").alias("work_id"), F.col("id").alias("sequence"), F.when(F.col("lang") == "en", "core").otherwise("commentary").alias("layer"), F.concat_ws(" ", "lang", "source").alias("place"), "text", "rank"
    )
    return rank.scored(rows, TERMS)


@query()
def selected_results(spark, t):
    """K13 for several queries at once."""
    pool = _pool(spark, t).select("query", F.col("id").cast("string").alias("id"), "work_id", "layer", F.lit("core_text").alias("speaker_type"), "tier", "score", "useful", "text", F.size("quoted_matches").alias("n_quoted"), F.size("focus_matches").alias("n_focus"), "preferred")
    return rank.chosen_results(pool).drop("omitted")


@query()
def packets(spark, t):
    """Chosen results in a character budget."""
    # The filter stands after the window: below it, its expressions would be computed once more for each use.
    pool = rank.capped(_pool(spark, t), ["query"], [F.col("useful").desc(), F.col("score").desc(), F.col("id")], 6).where("useful")
    rows = pool.select("query", "place", F.col("id").cast("string").alias("id"), "layer", F.when(F.col("place") > 4, "alternative").otherwise("results").alias("channel"), "text", F.lit(False).alias("anchor"))
    out = packet.packets(rows, 2500)
    join = lambda c: F.array_join(c, ",").alias(c)
    return out.select("query", join("core"), join("extension"), join("alternatives"), "used", "left_out", "clarification")


@query(f"""WITH x AS ({_BEST_SQL}), d AS (SELECT doc_id, lang, length({NORM('text')}) AS clean FROM documents)
SELECT coalesce(bool_or(tier IN ('A', 'B') AND clean >= 8), false) AS has_direct, coalesce(bool_or(tier IN ('A', 'B', 'C') AND clean >= 8 AND exact_body), false) AS has_exact,
coalesce(bool_or(tier IN ('A', 'B', 'C') AND clean >= 8 AND exact_body AND lang = 'en'), false) AS has_exact_core FROM x JOIN d USING (doc_id)""")
def sufficiency(spark, t):
    """K8: what the candidates suffice for."""
    rows = t("documents").select("doc_id", F.col("doc_id").alias("id"), F.lit("").alias("work_id"), F.lit(0).alias("sequence"), F.when(F.col("lang") == "en", "core").otherwise("commentary").alias("layer"), F.concat_ws(" ", "lang", "source").alias("place"), "text", F.lit(0.0).alias("rank"), F.lit("core_text").alias("speaker_type"))
    return rank.direct(rank.scored(rows, TERMS)).select("has_direct", "has_exact", "has_exact_core")


@query("""WITH r AS (SELECT o_orderkey AS query_id, l_linenumber AS id, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS place FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
e AS (SELECT DISTINCT l_orderkey AS query_id, l_linenumber AS id FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01') SELECT count(DISTINCT query_id)::BIGINT AS n, count(DISTINCT query_id) FILTER (query_id IN (SELECT query_id FROM r JOIN e USING (query_id, id) WHERE place <= 3))::BIGINT AS found,
round(count(DISTINCT query_id) FILTER (query_id IN (SELECT query_id FROM r JOIN e USING (query_id, id) WHERE place <= 3)) / count(DISTINCT query_id), 6)::DOUBLE AS recall FROM e""")
def recall_at_three(spark, t):
    """For orders with late lines, whether one of them is among the order's three dearest."""
    lines = t("lineitem").select(F.col("l_orderkey").alias("query_id"), F.col("l_linenumber").alias("id"), "l_extendedprice", "l_shipdate")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("l_extendedprice").desc(), "id"))
    return quality.recall_at(lines.where("l_shipdate >= timestamp '1997-01-01'").select("query_id", "id").distinct(), lines.withColumn("place", place), 3)


_SCORED_SQL = f"""x AS ({_BEST_SQL.replace('SELECT doc_id, term, eb AS exact_body', 'SELECT doc_id, length(term) AS lt, eb AS exact_body')}), d AS (SELECT doc_id, source, length(text) AS n, length({NORM('text')}) AS clean FROM documents),
sc AS (SELECT doc_id, source, round(CASE tier WHEN 'A' THEN 80 WHEN 'B' THEN 46 WHEN 'C' THEN 22 ELSE 0 END + coverage * 18 + CASE WHEN exact_body THEN least(lt, 16) ELSE 0 END + 3.5
 + CASE WHEN n BETWEEN 30 AND 360 THEN 4 WHEN n < 10 THEN -18 WHEN n < 20 THEN -7 WHEN n > 520 THEN -3 ELSE 0 END - CASE WHEN clean < 8 THEN 100 ELSE 0 END, 4)::DOUBLE AS score FROM x JOIN d USING (doc_id))"""


@query(f"WITH {_SCORED_SQL} SELECT doc_id, source, score FROM sc ORDER BY score DESC, source, doc_id LIMIT 50")
def score_order(spark, t):
    """K7: the best fifty by score, then work and sequence."""
    rows = t("documents").select("doc_id", F.col("source").alias("work_id"), F.col("doc_id").alias("sequence"), F.lit("core").alias("layer"), F.concat_ws(" ", "lang", "source").alias("place"), "text", F.lit(0.0).alias("rank"), F.col("doc_id").alias("id"))
    out = rank.scored(rows, TERMS)
    rounded = out.withColumn("score", F.round(F.col("score") - F.col("best.coverage") * 18 + F.round("best.coverage", 6) * 18, 4))
    return rank.in_order(rounded).limit(50).select("doc_id", F.col("work_id").alias("source"), "score")


@query("""WITH w AS (SELECT c_custkey AS id, CASE c_nationkey % 3 WHEN 0 THEN 'core' ELSE 'commentary' END AS layer, c_mktsegment AS canon, 't' || (c_nationkey % 5) AS target FROM customer), r AS (SELECT o_orderkey AS id, o_custkey AS work_id, -o_totalprice AS rank FROM orders)
SELECT r.id, work_id, rank FROM r JOIN w ON work_id = w.id WHERE layer = 'core' AND canon IN ('BUILDING', 'MACHINERY') AND target IN ('t1', 't2') ORDER BY rank, r.id LIMIT 80""")
def scoped_candidates(spark, t):
    """The scope filters before the candidate limit."""
    n = F.col("c_nationkey")
    works = t("customer").select(F.col("c_custkey").alias("id"), F.when(n % 3 == 0, "core").otherwise("commentary").alias("layer"), F.col("c_mktsegment").alias("canon"), F.col("c_name").alias("author"), F.array(F.concat(F.lit("t"), (n % 5).cast("string"))).alias("targets"))
    ranked = t("orders").select(F.col("o_orderkey").alias("id"), (-F.col("o_totalprice")).alias("rank"))
    passages = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("work_id"))
    route = retrieve.Route(canons=("BUILDING", "MACHINERY"), target_works=("t1", "t2"))
    return retrieve.candidates(ranked, passages, works, route, retrieve.Scope(layers=("core",)), 4, 40).select("id", "work_id", "rank")


@query("""WITH w AS (SELECT c_custkey AS id, c_nationkey % 5 AS k, c_mktsegment AS canon FROM customer) SELECT 'strict' AS mode, id FROM w WHERE k = 1 AND canon = 'BUILDING' AND id <> 5 UNION ALL SELECT 'relaxed', id FROM w WHERE id <> 5""")
def relaxed_scope(spark, t):
    """A relaxed route has no scope, but what is excluded stays so."""
    works = t("customer").select(F.col("c_custkey").alias("id"), F.lit("core").alias("layer"), F.col("c_mktsegment").alias("canon"), F.lit("").alias("author"), F.array((F.col("c_nationkey") % 5).cast("string")).alias("targets"))
    route = retrieve.Route(canons=("BUILDING",), target_works=("1",), excluded_work_ids=(5,))
    under = lambda r, mode: works.where(retrieve.work_filter(r, retrieve.Scope())).select(F.lit(mode).alias("mode"), "id")
    return under(route, "strict").unionByName(under(route.relaxed(), "relaxed"))
