"""Queries of the evidence layer and of measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import evidence, quality
from quire.plans.base import query

TOPICS = [("greet", "M1", ["hello", "thanks"]), ("trouble", "M3", ["error", "urgent"]), ("data", "M2", ["table", "data", "model"]), ("code", "M1", ["python", "code"])]
FLAGS = {"academic": ["quote", "source"], "current": ["now", "today"], "modern": ["science", "study"], "m2": ["effect", "safe"], "action": ["help", "how"]}


def _topics(spark):
    topics = spark.createDataFrame([(i, lvl) for i, lvl, _ in TOPICS], "id string, default_level string")
    aliases = spark.createDataFrame([(i, a, a) for i, _, names in TOPICS for a in names], "topic_id string, alias string, normalized_alias string")
    return topics, aliases


_VALUES = ", ".join(f"('{i}', '{lvl}', '{a}')" for i, lvl, names in TOPICS for a in names)
_MATCH_SQL = f"""WITH a(topic_id, level, alias) AS (VALUES {_VALUES}), q AS (SELECT conv_id * 1000 + turn AS query_id, lower(text) AS t FROM conversations),
m AS (SELECT query_id, topic_id, level, string_agg(alias, '+' ORDER BY -length(alias), alias) AS aliases FROM q JOIN a ON contains(t, alias) GROUP BY ALL)"""


def _queries(t):
    return t("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")


@query(_MATCH_SQL + " SELECT query_id, string_agg(topic_id || ':' || aliases, ',' ORDER BY level DESC, topic_id) AS topics FROM m GROUP BY query_id")
def topic_match(spark, t):
    """L2 of every turn."""
    topics, aliases = _topics(spark)
    found = evidence.match_topics(_queries(t), topics, aliases, F.lower)
    shown = F.transform("topics", lambda x: F.concat(x["id"], F.lit(":"), F.array_join(x["matched_aliases"], "+")))
    return found.select("query_id", F.array_join(shown, ",").alias("topics"))


def _flag_sql(k: str) -> str:
    return "(" + " OR ".join(f"contains(t, '{w}')" for w in FLAGS[k]) + ")"


@query(
    _MATCH_SQL + f""", l AS (SELECT query_id, bool_or(level = 'M1') AS m1, bool_or(level = 'M2') AS m2, bool_or(level = 'M3') AS m3 FROM m GROUP BY query_id),
f AS (SELECT query_id, t, coalesce(m1, false) AS m1, coalesce(m2, false) AS m2, coalesce(m3, false) AS m3 FROM q LEFT JOIN l USING (query_id))
SELECT query_id, CASE WHEN m3 AND ({_flag_sql('current')} OR {_flag_sql('action')} OR NOT {_flag_sql('academic')}) THEN 'M3' WHEN {_flag_sql('academic')} AND NOT {_flag_sql('current')} AND NOT {_flag_sql('modern')} AND NOT {_flag_sql('m2')} AND NOT {_flag_sql('action')} THEN 'M0'
 WHEN {_flag_sql('m2')} OR m2 THEN 'M2' WHEN {_flag_sql('modern')} OR m1 THEN 'M1' ELSE 'M0' END AS level FROM f"""
)
def classify_levels(spark, t):
    """L3 of every turn."""
    topics, aliases = _topics(spark)
    q = _queries(t)
    found = q.join(evidence.match_topics(q, topics, aliases, F.lower), "query_id", "left")
    flags = {k: F.size(evidence.markers(F.lower("text"), tuple(w))) > 0 for k, w in FLAGS.items()}
    levels = F.coalesce(F.transform("topics", lambda x: x["default_level"]), F.array().cast("array<string>"))
    return found.select("query_id", evidence.level(levels, flags).alias("level"))


@query("""WITH b AS (SELECT l_partkey AS record_id, l_returnflag AS topic_id, max(l_discount * 10) AS relevance FROM lineitem GROUP BY ALL), r AS (SELECT p_partkey AS id, p_brand AS confidence, p_size > 25 AS fresh FROM part WHERE p_size > 5),
h AS (SELECT record_id AS id, max(greatest(relevance, 0)) AS match_relevance FROM b WHERE topic_id IN ('R', 'A') GROUP BY 1), e AS (SELECT record_id AS id, string_agg(DISTINCT topic_id, '+' ORDER BY topic_id) AS topics FROM b GROUP BY 1)
SELECT 1::BIGINT AS query_id, id, round(match_relevance, 6)::DOUBLE AS match_relevance, confidence, topics FROM h JOIN r USING (id) JOIN e USING (id) WHERE fresh""")
def evidence_lookup(spark, t):
    """Parts as records, line items as their topics."""
    bridge = t("lineitem").groupBy(F.col("l_partkey").alias("record_id"), F.col("l_returnflag").alias("topic_id")).agg(F.max(F.col("l_discount") * 10).alias("relevance"))
    records = t("part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 5, "verified").otherwise("draft").alias("status"), F.col("p_brand").alias("confidence"), F.when(F.col("p_size") > 25, F.lit("2030-01-01")).otherwise(F.lit("2020-01-01")).cast("date").alias("expires_at"))
    wanted = spark.createDataFrame([(1, "R"), (1, "A")], "query_id long, topic_id string")
    out = evidence.lookup(wanted, records, bridge, F.lit("2025-01-01").cast("date"))
    return out.select("query_id", "id", F.round("match_relevance", 6).alias("match_relevance"), "confidence", F.array_join("topics", "+").alias("topics"))


DOMAINS = [("s1", 1, ["example.com"]), ("s2", 2, ["example.org", "news.example.com"]), ("s3", 3, ["org"]), ("s4", 2, ["net", "site0.example.net"])]
_DOMAIN_VALUES = ", ".join(f"('{i}', {p}, '{d}')" for i, p, ds in DOMAINS for d in ds)


@query(f"""WITH d(source_id, priority, domain) AS (VALUES {_DOMAIN_VALUES}), u AS (SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z]+://([^/:?#]*)', 1)) AS host, starts_with(lower(url), 'https://') AS ok FROM pages)
SELECT page_id, (SELECT arg_min(source_id, (priority, source_id)) FROM d WHERE u.ok AND (u.host = domain OR ends_with(u.host, '.' || domain))) AS source_id FROM u""")
def domain_allow_list(spark, t):
    """L9 of all pages."""
    registry = spark.createDataFrame(DOMAINS, "id string, priority int, domains array<string>")
    return evidence.approved(t("pages").select("page_id", "url"), registry).select("page_id", "source_id")


@query("""WITH r AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders) SELECT count(*)::BIGINT AS records, count(*) FILTER (o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1995-06-17')::BIGINT AS fresh, count(*) FILTER (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1995-06-17')::BIGINT AS stale FROM r""")
def conditional_status_counts(spark, t):
    """L10."""
    records = t("orders").select(F.when(F.col("o_orderstatus") == "F", "verified").otherwise("draft").alias("status"), F.col("o_orderdate").alias("expires_at"))
    return evidence.status(records, F.lit("1995-06-17").cast("timestamp"))


@query("""WITH v AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL)
SELECT event_type, f AS fraction, min(value) AS value FROM v, (VALUES (0.5), (0.95)) q(f) WHERE k = round_even((n - 1) * f, 0) GROUP BY ALL""".replace("(VALUES (0.5), (0.95))", "(SELECT unnest([0.5::DOUBLE, 0.95::DOUBLE]))"))
def percentile_nearest_rank(spark, t):
    """M8 for each type of event."""
    return quality.nearest_ranks(t("events"), ["event_type"], "value", (0.5, 0.95)).select("event_type", F.col("fraction").cast("double").alias("fraction"), "value")


@query("SELECT event_type, round(median(value), 9)::DOUBLE AS median FROM events GROUP BY event_type")
def interpolating_median(spark, t):
    """M9."""
    return t("events").groupBy("event_type").agg(F.round(F.median("value"), 9).alias("median"))


@query("SELECT round(avg((quality = 1)::INT), 6)::DOUBLE AS good, round(avg((toxic = 0)::INT), 6)::DOUBLE AS clean, round(avg(CASE WHEN quality = 1 THEN (toxic = 0)::INT END), 6)::DOUBLE AS clean_of_good FROM labels")
def acceptance_ratios(spark, t):
    """Shares of passed tests, some of which do not apply to every row."""
    return quality.ratios(t("labels"), {"good": F.col("quality") == 1, "clean": F.col("toxic") == 0, "clean_of_good": F.when(F.col("quality") == 1, F.col("toxic") == 0)})


@query("""WITH c AS (SELECT event_type AS name, count(*) > 100 AS passed, event_type LIKE 'p%' AS blocking FROM events GROUP BY event_type)
SELECT CASE WHEN bool_and(passed) THEN 'pass' WHEN bool_and(passed OR NOT blocking) THEN 'pass-with-warnings' ELSE 'blocked' END AS status, coalesce(string_agg(name, ',' ORDER BY name) FILTER (NOT passed), '') AS reasons FROM c""")
def gate_report(spark, t):
    """M6."""
    checks = t("events").groupBy(F.col("event_type").alias("name")).agg((F.count("*") > 100).alias("passed")).withColumn("blocking", F.startswith("name", F.lit("p")))
    return quality.gate(checks).select("status", F.array_join("reasons", ",").alias("reasons"))


@query("""SELECT 'unknown-source' AS "check", o_orderkey::VARCHAR AS id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) UNION ALL
SELECT 'relevance-out-of-range', l_orderkey::VARCHAR FROM lineitem WHERE l_discount > 0.08 UNION ALL SELECT 'no-topic', o_orderkey::VARCHAR FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def evidence_violations(spark, t):
    """Orders as records, line items as their topics, customers with a balance as sources."""
    records = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("source_id"), F.lit(1).alias("expires_at"), F.lit(0).alias("verified_at"))
    bridge = t("lineitem").select(F.col("l_orderkey").alias("record_id"), F.lit("t").alias("topic_id"), F.when(F.col("l_discount") > 0.08, 2.0).otherwise(F.col("l_discount")).alias("relevance"))
    registry = t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"))
    found = evidence.violations(records, bridge, registry, spark.createDataFrame([("t",)], "id string"))
    return found.where("check <> 'duplicate-link'")  # each line is a link here; evidence_audit has them


@query("""WITH p AS (SELECT n_nationkey::BIGINT AS query_id, (row_number() OVER (PARTITION BY n_nationkey ORDER BY s_suppkey) - 1)::INT AS place, 'M' || (1 + s_suppkey % 3) AS level, s_name AS z, upper(s_name) AS e FROM supplier JOIN nation ON s_nationkey = n_nationkey),
q AS (SELECT query_id, place * 2 AS n, 'zh' AS language, z || CASE level WHEN 'M3' THEN ' site:nhc.gov.cn OR site:gov.cn' WHEN 'M2' THEN ' 指南 药监' ELSE '' END AS query FROM p UNION ALL
SELECT query_id, place * 2 + 1, 'en', e || CASE level WHEN 'M3' THEN ' site:who.int OR site:cdc.gov OR site:nhs.uk' WHEN 'M2' THEN ' guideline systematic review' ELSE '' END FROM p),
f AS (SELECT query_id, query, min(n) AS n, arg_max(language, n) AS language FROM q GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n) AS place FROM f)
SELECT query_id, place::BIGINT AS place, language, query FROM r WHERE place <= 6""")
def online_plan(spark, t):
    """Distinct queries for each question, the first six."""
    from pyspark.sql import Window

    rows = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    place = F.row_number().over(Window.partitionBy("n_nationkey").orderBy("s_suppkey")) - 1
    topics = rows.select(F.col("n_nationkey").cast("long").alias("query_id"), place.alias("place"), F.concat(F.lit("M"), (1 + F.col("s_suppkey") % 3).cast("string")).alias("level"), F.col("s_name").alias("term_zh"), F.upper("s_name").alias("term_en"))
    return evidence.online_plan(topics).select("query_id", F.col("place").cast("long").alias("place"), "language", "query")


@query("""SELECT s.source, s.n::BIGINT AS n, s.chars::BIGINT AS chars, CASE WHEN coalesce(l.good, 0) = 0 THEN 'no good document' ELSE '' END AS reasons, CASE WHEN coalesce(l.good, 0) > 0 AND s.n >= 20 THEN 'final' ELSE 'candidate-blocked' END AS lock_status
FROM (SELECT source, count(*) AS n, sum(length(text)) AS chars FROM documents GROUP BY source) s LEFT JOIN (SELECT source, count(*) FILTER (quality = 1) AS good FROM documents JOIN labels USING (doc_id) GROUP BY source) l USING (source)""")
def source_lock(spark, t):
    """M7: sources with what speaks against them, whether they are complete, and how much of them was processed."""
    d = t("documents").withColumn("source_id", F.col("source"))
    inventory = d.groupBy("source_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).cast("long").alias("chars"))
    good = d.join(t("labels").where("quality = 1").select("doc_id"), "doc_id").groupBy("source_id").agg(F.count("*").alias("passages"))
    reasons = inventory.join(good, "source_id", "left_anti").select("source_id", F.array(F.lit("no good document")).alias("reasons"))
    out = quality.source_lock(inventory, reasons, inventory.select("source_id", F.when(F.col("n") >= 20, "pass").otherwise("fail").alias("status")), good)
    return out.select(F.col("source_id").alias("source"), "n", "chars", F.array_join("reasons", ",").alias("reasons"), "lock_status")


_LEVEL_SQL = "CASE WHEN contains(t, 'urgent') OR contains(t, 'error') THEN 'M3' WHEN contains(t, 'data') THEN 'M2' ELSE 'M0' END"


@query(f"""WITH q AS (SELECT conv_id * 1000 + turn AS query_id, lower(text) AS t FROM conversations), l AS (SELECT query_id, t, {_LEVEL_SQL} AS level FROM q)
SELECT query_id, CASE WHEN level = 'M3' THEN CASE WHEN contains(t, 'urgent') THEN md5('{evidence.SAFETY[True]}') ELSE md5('{evidence.SAFETY[False]}') END END AS message FROM l""")
def safety_messages(spark, t):
    """L4 of every turn."""
    q = _queries(t).withColumn("t", F.lower("text"))
    topics = F.array_compact(F.array(F.when(F.contains("t", F.lit("urgent")), evidence.SELF_HARM), F.when(F.contains("t", F.lit("error")), "other")))
    level = F.when(F.size(topics) > 0, "M3").when(F.contains("t", F.lit("data")), "M2").otherwise("M0")
    return q.select("query_id", F.md5(evidence.safety_message(topics, level)).alias("message"))


@query("""WITH q AS (SELECT n_nationkey AS query_id, 'M' || (n_nationkey % 4) AS level FROM nation), p AS (SELECT query_id, level, unnest(['a', 'b', 'c']) AS topic, unnest([0, 1, 2]) AS place FROM q WHERE level <> 'M0'),
k AS (SELECT * FROM p WHERE NOT (topic = 'b' AND query_id % 2 = 0)), s AS (SELECT query_id, level, place, CASE topic WHEN 'c' THEN 'title c' ELSE 'zh ' || topic END AS z, CASE topic WHEN 'c' THEN 'title c' ELSE 'en ' || topic END AS e FROM k),
u AS (SELECT query_id, place * 2 AS n, z || CASE level WHEN 'M3' THEN ' site:nhc.gov.cn OR site:gov.cn' WHEN 'M2' THEN ' 指南 药监' ELSE '' END AS query FROM s UNION ALL SELECT query_id, place * 2 + 1, e || CASE level WHEN 'M3' THEN ' site:who.int OR site:cdc.gov OR site:nhs.uk' WHEN 'M2' THEN ' guideline systematic review' ELSE '' END FROM s),
f AS (SELECT query_id, query, min(n) AS n FROM u GROUP BY ALL) SELECT query_id::BIGINT AS query_id, query, row_number() OVER (PARTITION BY query_id ORDER BY n)::BIGINT AS place FROM f""")
def planned_searches(spark, t):
    """L8 at the question's level, without topics that fresh records cover where no search is needed."""
    topic = lambda x: F.struct(F.lit(x).alias("id"))
    q = t("nation").select(F.col("n_nationkey").cast("long").alias("query_id"), F.concat(F.lit("M"), (F.col("n_nationkey") % 4).cast("string")).alias("level"), F.array(*map(topic, "abc")).alias("topics"))
    known = spark.createDataFrame([("a", "title a", ["zh a"], ["en a"]), ("b", "title b", ["zh b"], ["en b"]), ("c", "title c", [], [])], "id string, title_zh string, search_terms_zh array<string>, search_terms_en array<string>")
    asked = q.withColumn("modern_layer_required", F.col("level") != "M0")
    rows = evidence.planned_topics(asked, known, q.select("query_id", F.lit("b").alias("topic_id")), q.select("query_id", (F.col("query_id") % 2 == 1).alias("needs_online")))
    return evidence.online_plan(rows).select("query_id", "query", F.col("place").cast("long").alias("place"))


@query("""WITH r AS (SELECT o_orderkey AS id, o_custkey AS source_id, o_orderstatus AS org, CASE WHEN o_orderkey % 3 = 0 THEN 'https://x.test/' ELSE 'https://a.example.com/' END AS url FROM orders), s AS (SELECT c_custkey AS source_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'O' END AS organization FROM customer),
a AS (SELECT o_orderkey AS id, o_orderkey % 5 = 0 AS wrong FROM orders WHERE o_orderkey % 7 <> 0)
SELECT 'organization-mismatch' AS "check", id::VARCHAR AS id FROM r JOIN s USING (source_id) WHERE org <> organization UNION ALL SELECT 'domain-not-approved', id::VARCHAR FROM r JOIN s USING (source_id) WHERE url LIKE '%x.test%'
UNION ALL SELECT 'not-audited', id::VARCHAR FROM r WHERE id NOT IN (SELECT id FROM a) UNION ALL SELECT 'audit-mismatch', id::VARCHAR FROM a WHERE wrong UNION ALL SELECT 'duplicate-link', l_orderkey::VARCHAR FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""")
def evidence_audit(spark, t):
    """L11's rules on organizations, domains, audits and links."""
    id_ = F.col("o_orderkey")
    records = t("orders").select(id_.alias("id"), F.col("o_custkey").alias("source_id"), F.col("o_orderstatus").alias("source_organization"), F.when(id_ % 3 == 0, "https://x.test/").otherwise("https://a.example.com/").alias("url"), F.lit("h").alias("source_content_sha256"), F.lit(1).alias("expires_at"), F.lit(0).alias("verified_at"))
    registry = t("customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("O").alias("organization"), F.array(F.lit("example.com")).alias("domains"))
    bridge = t("lineitem").select(F.col("l_orderkey").alias("record_id"), F.lit("t").alias("topic_id"), F.lit(0.5).alias("relevance"))
    audit = records.where("id % 7 <> 0").select(F.col("id").alias("record_id"), "url", F.when(F.col("id") % 5 == 0, "x").otherwise("h").alias("sha256"), "source_id", F.lit(200).alias("http_status"))
    found = evidence.violations(records, bridge, registry, spark.createDataFrame([("t",)], "id string"), None, audit)
    return found.where(F.col("check").isin("organization-mismatch", "domain-not-approved", "not-audited", "audit-mismatch", "duplicate-link"))
