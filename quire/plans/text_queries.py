"""Queries of the text operators: normalizing, grams, hashes, quarantine, markup, segmentation."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import build, extract, quality, rank, segment, titles
from quire.plans.base import NORM, gram_set_sql, grams_sql, query, spread
from quire.sources import readers, shared

LETTERS = X.LETTER_KEEP


@query(f"SELECT doc_id, length(n)::BIGINT AS n, md5(n) AS digest FROM (SELECT doc_id, {NORM('text')} AS n FROM documents)")
def normalize_text(spark, t):
    """F5 over whole documents."""
    rows, n = X.once(t("documents").select("doc_id", "text"), n=X.normalize_query(F.col("text"), LETTERS)), F.col("n")
    return rows.select("doc_id", F.length(n).cast("long").alias("n"), F.md5(n).alias("digest"))


@query(f"""SELECT gram, count(*)::BIGINT AS df FROM (SELECT unnest({gram_set_sql('n')}) AS gram FROM (SELECT {NORM('text')} AS n FROM documents)) GROUP BY gram""")
def bigram_df(spark, t):
    """H5: document frequencies of bigrams."""
    rows = X.once(t("documents").select("text"), n=X.normalize_query(F.col("text"), LETTERS))
    grams = rows.select(F.explode(X.bigram_set(F.col("n"))).alias("gram"))
    return grams.groupBy("gram").agg(F.count("*").alias("df"))


@query(f"""SELECT gram, count(*)::BIGINT AS n FROM (SELECT unnest({grams_sql('n')}) AS gram FROM (SELECT {NORM('text')} AS n FROM documents)) GROUP BY gram""")
def bigram_counts(spark, t):
    """Bigrams with repeats."""
    rows = X.once(t("documents").select("text"), n=X.normalize_query(F.col("text"), LETTERS))
    return rows.select(F.explode(X.bigrams(F.col("n"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


@query("""SELECT source, count(*)::BIGINT AS n, sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS digest FROM documents GROUP BY source""")
def aggregate_hash(spark, t):
    """one digest over the ordered texts of each source."""
    return X.ordered_hashes(t("documents"), "source", ["doc_id"], "text")


@query("""SELECT sha256(coalesce(text, '')) AS key, count(*)::BIGINT AS n FROM documents GROUP BY ALL HAVING count(*) > 1""")
def duplicate_instances(spark, t):
    """M3: contents that stand more than once."""
    return quality.duplicates(t("documents"), F.sha2(F.coalesce("text", F.lit("")), 256))


ISSUE = {"word-all": r"\b(?:all|ALL)\b", "url": r"https?://[^ \n]+", "digits": r"[0-9]{5,}", "double-mark": r"[!?*#$%&]{2,}", "license": r"Licensed under|All rights reserved"}
ISSUE_SQL = {k: f"len(regexp_extract_all(text, '{p}'))" for k, p in ISSUE.items()}


@query("SELECT doc_id, " + ", ".join(f"{s}::BIGINT AS \"{k}\"" for k, s in ISSUE_SQL.items()) + ", (" + " + ".join(ISSUE_SQL.values()) + ") > 0 AS quarantined FROM documents")
def issue_counts_quarantine(spark, t):
    """G2 and G8 with patterns that both engines take."""
    found = t("documents").withColumn("m", X.issue_counts(F.col("text"), ISSUE))
    one = lambda k: F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(0)).cast("long").alias(k)
    return found.select("doc_id", *[one(k) for k in ISSUE], (F.size("m") > 0).alias("quarantined"))


@query("""SELECT count(*)::BIGINT AS passages, count(*) FILTER (quality = 1)::BIGINT AS citable, count(*) FILTER (quality IS DISTINCT FROM 1)::BIGINT AS quarantined,
sum(length(text))::BIGINT AS characters, max(length(text))::BIGINT AS longest, count(*) FILTER (length(text) = 0)::BIGINT AS empty, count(*) FILTER (length(text) > 700)::BIGINT AS too_long,
count(*) FILTER (regexp_matches(text, '[\\x{fffd}\\x{e000}-\\x{f8ff}]'))::BIGINT AS with_issues, count(DISTINCT source)::BIGINT AS works FROM documents LEFT JOIN labels USING (doc_id)""")
def passage_scan_metrics(spark, t):
    """M3: one pass over all passages."""
    rows = t("documents").join(t("labels"), "doc_id", "left").withColumn("work_id", F.col("source"))
    return quality.passage_scan(rows, "text", F.coalesce(F.col("quality") == 1, F.lit(False)))


@query("""WITH p AS (SELECT source, doc_id, text, lag(text) OVER (PARTITION BY source ORDER BY doc_id) AS before FROM documents),
d AS (SELECT source, doc_id, string_split(text, '') AS a, string_split(before, '') AS b, least(length(text), length(before)) AS n, abs(length(text) - length(before)) AS gap FROM p WHERE before IS NOT NULL)
SELECT source, doc_id, (len(list_filter(list_zip(a[1:n], b[1:n]), lambda z: z[1] <> z[2])) + gap)::BIGINT AS differences FROM d""")
def diff_statistics(spark, t):
    """F8: character differences of each document from the one before it in its source. Only ids pass the window."""
    d = t("documents")
    pairs = d.select("source", "doc_id", F.lag("doc_id").over(Window.partitionBy("source").orderBy("doc_id")).alias("old")).where("old is not null")
    rows = pairs.join(d.select("doc_id", "text"), "doc_id").join(d.select(F.col("doc_id").alias("old"), F.col("text").alias("before")), "old").where("before is not null")
    return rows.select("source", "doc_id", X.char_differences(F.col("text"), F.col("before")).cast("long").alias("differences"))


STRIP_SQL = r"""regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(
 regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<script\b[^>]*>.*?</script>', '', 'g'), '(?is)<style\b[^>]*>.*?</style>', '', 'g'), '(?i)<br\s*/?>', chr(10), 'g'), '<[^>]+>', ' ', 'g'),
 '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&amp;', '&'), '[ \t\x{a0}]+', ' ', 'g'), '\s*\n\s*', chr(10), 'g')"""


@query(f"SELECT page_id, length(s)::BIGINT AS n, md5(s) AS digest FROM (SELECT page_id, {STRIP_SQL} AS s FROM pages)")
def html_strip(spark, t):
    """C5 for web pages."""
    s = X.strip_html(F.col("html"))
    return t("pages").select("page_id", F.length(s).cast("long").alias("n"), F.md5(s).alias("digest"))


@query(r"""SELECT page_id, place::BIGINT AS place, trim(heads[place]) AS heading FROM (SELECT page_id, regexp_extract_all(html, '(?is)<h[1-6][^>]*>([^<]*)</h[1-6]>', 1) AS heads, unnest(range(1, len(heads) + 1)) AS place FROM pages)""")
def heading_extract(spark, t):
    """C3 for web pages: headings in order."""
    heads = F.regexp_extract_all("html", F.lit(r"(?is)<h[1-6][^>]*>([^<]*)</h[1-6]>"), F.lit(1))
    return t("pages").select("page_id", F.posexplode(heads).alias("k", "h")).select("page_id", (F.col("k") + 1).cast("long").alias("place"), F.trim("h").alias("heading"))


@query(r"""SELECT page_id, count(*)::BIGINT AS links, count(*) FILTER (regexp_matches(l, '^https://'))::BIGINT AS secure FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)href="([^"]*)"', 1)) AS l FROM pages) GROUP BY page_id""")
def link_counts(spark, t):
    """A22's pattern: codes found in markup, counted."""
    links = t("pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('(?i)href="([^"]*)"'), F.lit(1))).alias("l"))
    return links.groupBy("page_id").agg(F.count("*").alias("links"), F.count_if(F.startswith("l", F.lit("https://"))).alias("secure"))


@query()
def bounded_split(spark, t):
    """G1 over whole documents; tested by its own rules."""
    cut = t("documents").select("doc_id", F.posexplode(segment.pieces(F.col("text"), with_text=False)).alias("place", "p"))
    return cut.select("doc_id", F.col("place").cast("long").alias("place"), F.col("p.start").cast("long").alias("start"), F.col("p.end").cast("long").alias("end"))


@query()
def segmented_passages(spark, t):
    """Documents of a source as blocks, to numbered, linked passages."""
    blocks = t("documents").select(F.col("source").alias("work_id"), F.lit("core_text").alias("speaker_type"), "doc_id", "text")
    done = segment.segmented(blocks, ["doc_id"])
    done = segment.linked(done, ["work_id"], ["sequence"], "passage_id", F.col("citable"))
    return done.select("passage_id", "work_id", "doc_id", F.col("sequence").cast("long").alias("sequence"), F.length("segment").cast("long").alias("n"), "quarantined", "previous_id", "next_id", "previous_citable_id", "next_citable_id")


@query()
def best_excerpts(spark, t):
    """K9: the sentence of each document that supports a term best."""
    out = t("documents").withColumn("e", rank.excerpts(F.col("text"), F.lit("the")))
    return out.select("doc_id", F.col("e.start").cast("long").alias("start"), F.col("e.end").cast("long").alias("end"), F.md5("e.quote").alias("digest"))


@query("SELECT n_nationkey::BIGINT AS parent, s::BIGINT AS scan_number FROM (SELECT n_nationkey, unnest(range(n_regionkey, n_nationkey + 1)) AS s FROM nation WHERE n_nationkey >= n_regionkey)")
def range_expand(spark, t):
    """Ranges to rows; reversed ones are not expanded."""
    tag = F.format_string('<pages index="n" from="%d" to="%d">', "n_regionkey", "n_nationkey")
    rows = extract.transclusions(t("nation").select("n_nationkey", tag.alias("raw")))
    return rows.where("error is null").select(F.col("n_nationkey").cast("long").alias("parent"), F.col("scan_number").cast("long").alias("scan_number"))


@query("SELECT DISTINCT url, lower(regexp_replace(replace(replace(url_encode(url), '+', '%20'), '*', '%2A'), '%7E', '~', 'g')) AS quoted FROM pages")
def url_quoting(spark, t):
    """J16's percent-encoding; in lower case, as engines differ there."""
    return t("pages").select("url", F.lower(X.url_quote(F.col("url"))).alias("quoted")).distinct()


NAMES = ["almond antique", "blue", "cream lace", "Part", "green", "1"]
TITLE_SQL = "lower(regexp_replace({0}, '[^0-9a-zA-Z]+', '', 'g'))"


@query(
    "WITH q(query) AS (VALUES " + ", ".join(f"('{x}')" for x in NAMES) + f"""), n AS (SELECT query, p_partkey, p_name, {TITLE_SQL.format('query')} AS q, {TITLE_SQL.format('p_name')} AS t FROM part, q),
s AS (SELECT *, list_distinct(string_split(q, '')) AS a, list_distinct(string_split(t, '')) AS b FROM n)
SELECT query, p_partkey, round(CASE WHEN q = '' OR t = '' THEN 0.0 WHEN q = t THEN 100.0 WHEN starts_with(t, q) THEN 90.0 WHEN contains(t, q) THEN 78.0 WHEN contains(q, t) THEN 70.0
 ELSE 60.0 * len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) END - CASE WHEN q <> '' AND t <> '' AND contains(p_name, '/') THEN 12.0 ELSE 0.0 END, 2)::DOUBLE AS score FROM s"""
)  # the two penalties that depend on Chinese titles are those of title_penalties below
def title_scores(spark, t):
    """B2 of all part names against a few titles."""
    q = spark.createDataFrame([(x,) for x in NAMES], "query string")
    both = t("part").select("p_partkey", "p_name").crossJoin(q)  # a handful of stated queries against all rows
    lower = lambda c: F.regexp_replace(F.lower(c), "[^0-9a-z]+", "")
    return both.select("query", "p_partkey", X.title_score(F.col("query"), F.col("p_name"), lower("query"), lower("p_name")).alias("score"))


@query("""WITH RECURSIVE r(name, target, depth) AS (SELECT n_name, n_name, 0 FROM nation UNION ALL SELECT r.name, m.n_name, depth + 1 FROM r JOIN nation n ON r.target = n.n_name JOIN nation m ON m.n_nationkey = n.n_regionkey AND m.n_nationkey <> n.n_nationkey)
SELECT name, arg_max(target, depth) AS target FROM r GROUP BY name""")
def alias_redirect(spark, t):
    """Redirects (here: a nation to the nation numbered by its region) followed to their end."""
    n = t("nation")
    to = n.alias("a").join(n.alias("b"), (F.col("b.n_nationkey") == F.col("a.n_regionkey")) & (F.col("b.n_nationkey") != F.col("a.n_nationkey"))).select(F.col("a.n_name").alias("name"), F.col("b.n_name").alias("to"))
    return titles.resolved(to, n.select(F.col("n_name").alias("name")))


@query("SELECT c_custkey, ((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 40)::BIGINT AS batch FROM customer")
def batches(spark, t):
    """A10: fixed-size groups."""
    return titles.batched(t("customer"), "c_custkey", 40, "c_nationkey").select("c_custkey", F.col("batch").cast("long").alias("batch"))


@query("SELECT r_regionkey::BIGINT AS parent_no, 0::BIGINT AS child_no, r_name AS title, count(n_name) = 0 AS include FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL UNION ALL SELECT n_regionkey::BIGINT, n_nationkey::BIGINT + 1, n_name, true FROM nation")
def interleaved_pages(spark, t):
    """Parents and their children in order."""
    top = t("region").select(F.col("r_regionkey").cast("long").alias("parent_no"), F.col("r_name").alias("title"))
    kids = t("nation").select(F.col("n_regionkey").cast("long").alias("parent_no"), (F.col("n_nationkey").cast("long") + 1).alias("child_no"), F.col("n_name").alias("title"))
    return titles.interleaved(top, kids).select("parent_no", F.col("child_no").cast("long").alias("child_no"), "title", "include")


@query("SELECT event_id, array_to_string(list_filter(list_transform(string_split(replace(event_type, '_', ',') || ', ,x', ','), lambda v: trim(v)), lambda v: v <> ''), '|') AS parts FROM events")
def relationship_split(spark, t):
    """B6."""
    return t("events").select("event_id", F.array_join(X.split_relationship(F.concat(F.replace("event_type", F.lit("_"), F.lit(",")), F.lit(", ,x"))), "|").alias("parts"))


@query("SELECT event_id, substr(sha256('{\"operation\":\"' || event_type || '\",\"params\":{\"id\":' || event_id || '}}'), 1, 20) AS key FROM events")
def cache_keys(spark, t):
    """A5."""
    return t("events").select("event_id", titles.cache_key(F.col("event_type"), F.struct(F.col("event_id").alias("id"))).alias("key"))


@query()
def wiki_blocks(spark, t):
    """C1 to C11 over web pages as sources of raw text: markup to blocks with headings carried forward."""
    pages = t("pages").select(F.lit("web").alias("source_id"), F.col("page_id").cast("int").alias("page_no"), F.col("html").alias("raw"))
    return extract.blocks(pages).select("source_id", "page_no", "token_no", "volume", "section", "subsection", "kind", "speaker", F.md5("text").alias("digest"))




@query("""WITH f AS (SELECT doc_id, text, source, (length(text) - length(replace(text, ' the ', ''))) // 5 AS n FROM documents)
SELECT doc_id, md5(CASE WHEN n > 0 THEN replace(text, ' the ', ' THE ') ELSE text END) AS digest, n > 0 AS corrected FROM f""")
def corrections(spark, t):
    """A literal correction for each document that has the words, as often as it has them."""
    d = t("documents").select(F.col("doc_id").alias("passage_id"), F.col("source").alias("source_id"), "text")
    n = ((F.length("text") - F.length(F.replace("text", F.lit(" the "), F.lit("")))) / 5).cast("int")
    fixes = d.select("passage_id", "source_id", F.lit("c1").alias("correction_id"), F.lit(" the ").alias("before"), F.lit(" THE ").alias("after"), n.alias("expected")).where("expected > 0")
    return segment.corrected(d, fixes).select(F.col("passage_id").alias("doc_id"), F.md5("text").alias("digest"), F.col("correction_ids").isNotNull().alias("corrected"))


@query("""WITH n AS (SELECT p_partkey, '伤寒论' || CASE p_partkey % 5 WHEN 0 THEN '序' WHEN 1 THEN '集注' WHEN 2 THEN '总目' WHEN 3 THEN '/卷' ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN '續文獻通考' ELSE '' END AS title FROM part)
SELECT p_partkey, CASE WHEN title = '伤寒论' THEN 100.0 ELSE greatest(0, 90.0 - CASE WHEN contains(title, '/') THEN 12.0 ELSE 0 END - CASE WHEN title IN ('伤寒论序', '伤寒论集注') THEN 20.0 ELSE 0 END - CASE WHEN contains(title, '續文獻通考') THEN 30.0 ELSE 0 END) END::DOUBLE AS score FROM n""")
def title_penalties(spark, t):
    """B1 and B2: what is taken off for prefaces, collected works and subpages."""
    k = F.col("p_partkey")
    end = F.when(k % 5 == 0, "序").when(k % 5 == 1, "集注").when(k % 5 == 2, "总目").when(k % 5 == 3, "/卷").otherwise("")
    title = F.concat(F.lit("伤寒论"), end, F.when(k % 3 == 0, "續文獻通考").otherwise(""))
    return t("part").select("p_partkey", X.title_score(F.lit("傷寒論"), title).alias("score"))


@query("""WITH q AS (SELECT n_nationkey AS work_id, 1 AS query_no, n_name AS query FROM nation), s AS (SELECT n_nationkey AS work_id, unnest([n_name, n_name || ' x', 'x ' || n_name]) AS title, unnest([100.0, 90.0, 78.0]) AS score FROM nation)
SELECT work_id::BIGINT AS work_id, title, score::DOUBLE AS score, row_number() OVER (PARTITION BY work_id ORDER BY score DESC, title)::BIGINT AS place, CASE WHEN score >= 90 THEN 'match' WHEN score >= 70 THEN 'candidate' ELSE 'none' END AS status FROM s""")
def best_titles(spark, t):
    """The best titles found for each work; a query after one that scored 100 doesn't count."""
    n = t("nation").select(F.col("n_nationkey").cast("long").alias("work_id"), "n_name")
    queries = n.select("work_id", F.lit(1).alias("query_no"), F.col("n_name").alias("query")).unionByName(n.select("work_id", F.lit(2).alias("query_no"), F.concat(F.lit("later "), "n_name").alias("query")))
    found = queries.select("query", F.explode(F.array(F.col("query"), F.concat("query", F.lit(" x")), F.concat(F.lit("x "), "query"))).alias("title"))
    return titles.discover(queries, found).select("work_id", "title", "score", F.col("place").cast("long").alias("place"), "status")


@query("SELECT p_partkey, p_size::BIGINT AS n, (p_partkey % 10)::BIGINT AS digit FROM part")
def numerals(spark, t):
    """Sizes written as numerals with units, and digits, read again."""
    size, digit = F.col("p_size").cast("int"), F.substring(F.lit("〇一二三四五六七八九"), (F.col("p_partkey") % 10 + 1).cast("int"), F.lit(1))
    say = lambda k: F.substring(F.lit("零一二三四五六七八九"), k + 1, F.lit(1))
    tens, ones = (size / 10).cast("int"), size % 10
    text = F.concat(F.when(tens > 1, say(tens)).otherwise(""), F.when(tens > 0, "十").otherwise(""), F.when((ones > 0) | (tens == 0), say(ones)).otherwise(""))
    return t("part").select("p_partkey", X.chinese_number(text).alias("n"), X.chinese_number(digit).alias("digit"))


@query("SELECT p_size::BIGINT AS leaf, row_number() OVER (ORDER BY p_size)::BIGINT AS place FROM (SELECT DISTINCT p_size FROM part)")
def page_order(spark, t):
    """Pages named by numbers, in reading order and not in that of their names."""
    leaves = t("part").select("p_size").distinct().withColumn("key", X.page_key(F.concat(F.lit("book/卷"), F.col("p_size").cast("string"))))
    return leaves.select(F.col("p_size").cast("long").alias("leaf"), F.row_number().over(Window.orderBy("key")).cast("long").alias("place"))  # a row for each size


@query(f"SELECT doc_id, md5({NORM('text')}) AS digest FROM documents")
def index_normalized(spark, t):
    """the index's normalizer over whole documents."""
    return t("documents").select("doc_id", F.md5(X.normalize_index(F.col("text"), LETTERS)).alias("digest"))


@query(f"SELECT doc_id, md5({NORM('text')}) AS digest FROM documents")
def evidence_normalized(spark, t):
    """the evidence layer's normalizer over whole documents."""
    return t("documents").select("doc_id", F.md5(X.normalize_evidence(F.col("text"), LETTERS)).alias("digest"))


@query("SELECT doc_id, md5(replace(lower(text), ' ', '')) AS digest FROM documents")
def alias_normalized(spark, t):
    """only spaces go."""
    return t("documents").select("doc_id", F.md5(X.normalize_alias(F.col("text"))).alias("digest"))


@query(f"SELECT doc_id, md5({NORM('text')}) AS digest FROM documents")
def corpus_normalized(spark, t):
    """compatibility forms composed, letters and digits kept."""
    return t("documents").select("doc_id", F.md5(X.normalize_corpus(F.col("text"))).alias("digest"))


_HAN = "SELECT p_partkey, substr('問靈樞傷論匱難經溫條黃帝內陰陽氣脈證湯藥', 1 + (p_partkey % 12)::INT, 9) AS old FROM part"


@query(f"WITH h AS ({_HAN}) SELECT p_partkey, translate(old, '問靈樞傷論匱難經溫條黃帝內陰陽氣脈證湯藥', '问灵枢伤论匮难经温条黄帝内阴阳气脉证汤药') AS simplified, old AS traditional FROM h")
def script_conversion(spark, t):
    """to simplified characters and back."""
    old = F.substring(F.lit("問靈樞傷論匱難經溫條黃帝內陰陽氣脈證湯藥"), (F.col("p_partkey") % 12 + 1).cast("int"), F.lit(9))
    new = X.convert_script(old)
    return t("part").select("p_partkey", new.alias("simplified"), X.convert_script(new, back=True).alias("traditional"))


@query("""WITH h AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '荣卫之气' WHEN 1 THEN '五藏六府' WHEN 2 THEN '盛则写之' WHEN 3 THEN '宜写不宜补' WHEN 4 THEN '传写其文' ELSE '溢写' END AS x FROM part)
SELECT p_partkey, CASE x WHEN '荣卫之气' THEN '营卫之气' WHEN '五藏六府' THEN '五脏六腑' WHEN '盛则写之' THEN '盛则泻之' WHEN '宜写不宜补' THEN '宜泻不宜补' WHEN '溢写' THEN '溢泻' ELSE x END AS shown FROM h""")
def display_readings(spark, t):
    """literal readings and those by context; 传写 stays."""
    k = F.col("p_partkey") % 6
    x = F.when(k == 0, "荣卫之气").when(k == 1, "五藏六府").when(k == 2, "盛则写之").when(k == 3, "宜写不宜补").when(k == 4, "传写其文").otherwise("溢写")
    return t("part").select("p_partkey", X.display_text(x).alias("shown"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS content_sha256 FROM documents")
def content_hashes(spark, t):
    """G10."""
    return t("documents").select("doc_id", segment.content_hash(F.col("text")).alias("content_sha256"))


@query("""SELECT source, count(*)::BIGINT AS n, sha256(string_agg(lang || chr(0) || doc_id || chr(0) || sha256(text) || chr(10), '' ORDER BY doc_id)) AS digest FROM documents GROUP BY source""")
def pages_hash(spark, t):
    """title, revision and sha of the pages of each source, in order."""
    pages = t("documents").select("source", F.col("lang").alias("title"), F.col("doc_id").alias("revision_id"), F.sha2("text", 256).alias("raw_sha256"), "doc_id")
    return X.pages_hashes(pages, "source", ["doc_id"])


_ISSUE_ROWS = " UNION ALL ".join(f"SELECT doc_id, source, '{k}' AS issue, {s} AS n FROM documents" for k, s in ISSUE_SQL.items())


@query(f"SELECT doc_id AS passage_id, source AS work_id, issue, n::BIGINT AS n FROM ({_ISSUE_ROWS}) WHERE n > 0")
def quarantine_rows(spark, t):
    """What is quarantined, one issue to a row."""
    rows = t("documents").select(F.col("doc_id").alias("passage_id"), F.col("source").alias("work_id"), X.issue_counts(F.col("text"), ISSUE).alias("issues")).withColumn("citable", F.size("issues") == 0)
    return build.quarantine(rows)


@query("""WITH d AS (SELECT source AS work_id, doc_id, text, coalesce(quality = 1, false) AS citable FROM documents LEFT JOIN labels USING (doc_id))
SELECT work_id, count(*)::BIGINT AS passages, count(*) FILTER (citable)::BIGINT AS citable, count(*) FILTER (NOT citable)::BIGINT AS quarantined, sum(length(text))::BIGINT AS characters, max(length(text))::BIGINT AS longest,
sha256(string_agg(sha256(text) || chr(10), '' ORDER BY doc_id)) AS content_digest FROM d GROUP BY work_id""")
def work_summaries(spark, t):
    """Counts and a digest of each work."""
    rows = t("documents").join(t("labels").select("doc_id", "quality"), "doc_id", "left").select(F.col("source").alias("work_id"), F.col("doc_id").alias("sequence"), F.col("text").alias("segment"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("citable"))
    out = build.work_summaries(rows.withColumn("content_sha256", segment.content_hash(F.col("segment"))))
    return out.select("work_id", *[F.col(c).cast("long").alias(c) for c in ("passages", "citable", "quarantined", "characters", "longest")], "content_digest")


@query(r"""WITH p AS (SELECT page_id, url, split_part(url, '/', 3) AS source_id, page_id % 3 <> 0 AS include, len(regexp_extract_all(html, '(?i)<h[1-6]')) AS heads, length(html) AS n, regexp_extract_all(html, '(?i)<h([1-6])', 1) AS levels FROM pages),
l AS (SELECT source_id, string_agg(k || '=' || c, ',' ORDER BY k) AS levels FROM (SELECT source_id, k, count(*) AS c FROM (SELECT source_id, unnest(levels) AS k FROM p WHERE include) GROUP BY ALL) GROUP BY source_id)
SELECT p.source_id, count(*) FILTER (include)::BIGINT AS included, count(*) FILTER (page_id % 5 = 0)::BIGINT AS hash_mismatches, coalesce(sum(n) FILTER (include), 0)::BIGINT AS characters, coalesce(sum(heads) FILTER (include), 0)::BIGINT AS headings, count(DISTINCT url) FILTER (include AND url LIKE '%1%')::BIGINT AS volumes, any_value(l.levels) AS levels
FROM p LEFT JOIN l USING (source_id) GROUP BY p.source_id""")
def raw_page_metrics(spark, t):
    """M1 of web pages, by host."""
    pages = t("pages").select(
        F.split_part("url", F.lit("/"), F.lit(3)).alias("source_id"), F.col("page_id").alias("page_no"), F.replace("url", F.lit("/"), F.lit("|")).alias("title"), F.lit(None).cast("string").alias("parent_title"), F.array().cast("array<string>").alias("categories"),
        (F.col("page_id") % 3 != 0).alias("include"), F.col("html").alias("raw"), F.when(F.col("page_id") % 5 == 0, "x").otherwise(F.sha2("html", 256)).alias("raw_sha256"),
    )
    out = quality.raw_metrics(pages, heading="(?i)<h[1-6]", volume="1", level="(?i)<h([1-6])")
    shown = F.array_join(F.transform(F.map_entries("levels"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ",")
    return out.select("source_id", "included", "hash_mismatches", "characters", "headings", "volumes", shown.alias("levels"))


@query("""WITH m AS (SELECT source, count(*) AS included, count(DISTINCT lang) AS volumes, sum(n_chars) AS headings FROM documents GROUP BY source), e AS (SELECT 'src' || n_nationkey AS source, CASE WHEN n_nationkey % 2 = 0 THEN 'volume' ELSE 'chapter' END AS kind, CASE WHEN n_nationkey % 2 = 0 THEN 4 ELSE 100000 END AS least FROM nation WHERE n_nationkey < 10)
SELECT source AS source_id, coalesce(kind, 'nonempty-corpus') AS kind, coalesce(least, 1)::BIGINT AS minimum_accepted, (CASE WHEN kind IS NULL THEN included WHEN kind = 'volume' THEN volumes ELSE headings END)::BIGINT AS observed,
CASE WHEN (CASE WHEN kind IS NULL THEN included WHEN kind = 'volume' THEN volumes ELSE headings END) >= coalesce(least, 1) THEN 'pass' ELSE 'fail' END AS status FROM m LEFT JOIN e USING (source)""")
def structure_check(spark, t):
    """M2: what is observed of each source against what is expected at least."""
    metrics = t("documents").groupBy(F.col("source").alias("source_id")).agg(F.count("*").alias("included"), F.count_distinct("lang").alias("volumes"), F.sum("n_chars").alias("headings"))
    even = F.col("n_nationkey") % 2 == 0
    expected = t("nation").where("n_nationkey < 10").select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("source_id"), F.when(even, "volume").otherwise("chapter").alias("kind"), F.when(even, 4).otherwise(100000).alias("minimum_accepted"))
    out = quality.structure(metrics, expected)
    return out.select("source_id", "kind", F.col("minimum_accepted").cast("long").alias("minimum_accepted"), F.col("observed").cast("long").alias("observed"), "status")


@query("""WITH c AS (SELECT c_nationkey, count(*) FILTER (c_mktsegment = 'BUILDING') AS low, count(*) FILTER (c_acctbal < -900) AS bad FROM customer GROUP BY c_nationkey)
SELECT n_name AS source_id, concat_ws('; ', CASE WHEN n_regionkey = 1 AND low > 0 THEN 'core source has upstream 25%/50% quality category and lacks completed second-base collation' END, CASE WHEN bad > 0 THEN 'ProofreadPage contains ' || bad || ' unproofread/problem pages' END) AS reasons FROM nation JOIN c ON c_nationkey = n_nationkey""")
def upstream_reasons(spark, t):
    """M5."""
    per = t("customer").groupBy("c_nationkey").agg(F.count_if(F.col("c_mktsegment") == "BUILDING").alias("low"), F.count_if(F.col("c_acctbal") < -900).alias("bad"))
    rows = per.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("source_id"), F.create_map(F.lit("25%"), F.col("low")).alias("categories"), F.create_map(F.lit("1"), F.col("bad")).alias("levels"), F.when(F.col("n_regionkey") == 1, "core").otherwise("commentary").alias("layer"))
    return quality.upstream_blocks(rows.drop("layer"), rows.select("source_id", "layer")).select("source_id", F.array_join("reasons", "; ").alias("reasons"))


@query("""WITH d AS (SELECT doc_id, substr(text, 1, 180) AS t, coalesce(quality = 1, false) AS citable, regexp_matches(text, 'https?://') AS url, len(regexp_extract_all(text, '[!?*#$%&]{2,}')) AS marks FROM documents LEFT JOIN labels USING (doc_id)),
i AS (SELECT doc_id, t, citable, 'url' AS issue, true AS blocking, url::INT AS n FROM d WHERE url UNION ALL SELECT doc_id, t, citable, 'marks', false, marks FROM d WHERE marks > 0), k AS (SELECT *, row_number() OVER (PARTITION BY issue ORDER BY doc_id) AS k FROM i)
SELECT issue, blocking, sum(n)::BIGINT AS n, coalesce(sum(n) FILTER (citable), 0)::BIGINT AS n_citable, md5(string_agg(t, '|' ORDER BY doc_id) FILTER (k <= 3)) AS examples FROM k GROUP BY issue, blocking""")
def passage_issue_report(spark, t):
    """M3: blocking and warning issues with their first examples."""
    rows = t("documents").join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    out = quality.passage_issues(rows, "text", ["doc_id"], F.coalesce(F.col("quality") == 1, F.lit(False)), {"url": "https?://"}, {"marks": "[!?*#$%&]{2,}"})
    return out.select("issue", "blocking", "n", "n_citable", F.md5(F.array_join("examples", "|")).alias("examples"))


@query("""WITH d AS (SELECT source, doc_id AS id, doc_id % 4 <> 0 AS citable FROM documents), l AS (SELECT *, lag(id) OVER w AS p, lead(id) OVER w AS n FROM d WINDOW w AS (PARTITION BY source ORDER BY id))
SELECT 'quarantine-search-text-leak' AS fault, count(*) FILTER (NOT citable AND id % 3 = 0)::BIGINT AS n FROM d UNION ALL SELECT 'broken-passage-links', count(*) FILTER (p IS NOT NULL OR n IS NOT NULL)::BIGINT FROM l WHERE id % 10 = 0""")
def status_fault_counts(spark, t):
    """M3: states that contradict themselves, and links that are not those of the neighbours."""
    id_ = F.col("doc_id")
    d = t("documents").select("source", id_.alias("id"), (id_ % 4 != 0).alias("citable")).withColumns({"searchable": F.col("citable"), "quality_status": F.when(F.col("citable"), "clean").otherwise("quarantined")})
    d = d.withColumns({"text_search": F.when(F.col("citable") | (F.col("id") % 3 == 0), "x").otherwise(""), "flags": F.array(F.lit("f"))})
    d = segment.linked(d, ["source"], ["id"], "id", F.col("citable"))
    broken = F.col("id") % 10 == 0
    d = d.withColumns({c: F.when(~broken, F.col(c)) for c in ("previous_id", "next_id")})
    return quality.status_faults(d, ["source"], ["id"])


@query("SELECT doc_id, trim(replace(lang || source || 'x', ' ', '')) AS title, length(lang || source || 'x')::BIGINT AS n FROM documents")
def title_texts(spark, t):
    """H6: the text of the index's title side."""
    title = build.title_text(F.col("lang"), F.col("source"), F.lit(None).cast("string"), F.lit("x"))
    return t("documents").select("doc_id", title.alias("title"), F.length(title).cast("long").alias("n"))


@query("SELECT r_regionkey::BIGINT AS source_id, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::BIGINT AS page_sequence, n_name AS title FROM region JOIN nation ON n_regionkey = r_regionkey")
def source_pages(spark, t):
    """H2: the pages of each source, numbered from 0."""
    pages = t("nation").groupBy(F.col("n_regionkey").cast("long").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.struct(x["n_name"].alias("title"))).alias("pages"))
    none = spark.createDataFrame([], "id string, targets array<string>")
    return build.metadata(none, none, pages)["source_pages"].select("source_id", F.col("page_sequence").cast("long").alias("page_sequence"), "title")


@query("SELECT DISTINCT p_brand AS work_id, unnest([p_type, 'size ' || p_size]) AS target_work FROM part")
def work_targets(spark, t):
    """H2: a row for each target of a work."""
    works = t("part").groupBy(F.col("p_brand").alias("id")).agg(F.flatten(F.collect_set(F.array(F.col("p_type"), F.concat(F.lit("size "), F.col("p_size").cast("string"))))).alias("targets"))
    return build.metadata(works, works.select("id"), spark.createDataFrame([], "id string, pages array<struct<title:string>>"))["work_targets"]


@query("SELECT DISTINCT lang, source FROM documents")
def dimension_values(spark, t):
    """H3: distinct values of a dimension; its ids are hashes of them."""
    return build.dimension(t("documents"), ["lang", "source"]).select("lang", "source")


@query("SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 0")
def citable_rows(spark, t):
    """H4."""
    d = t("documents").join(t("labels"), "doc_id").withColumns({"citable": F.col("quality") == 1, "searchable": F.col("toxic") == 0, "quality_status": F.lit("clean")})
    return build.citable_only(d.where(F.length("text") > 0)).select("doc_id")


@query("SELECT c_custkey AS id, c_name AS title, o.n::BIGINT AS n FROM customer JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'")
def selected_candidates(spark, t):
    """Chosen candidates that an audit has."""
    audit = t("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"))
    return build.selected_works(t("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id")), t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title")), audit)


@query("SELECT page_id FROM pages WHERE regexp_matches(url, '[02468]$')")
def included_pages(spark, t):
    """A13."""
    return build.included(t("pages").select("page_id", F.col("url").alias("title")), "[02468]$").select("page_id")


@query("SELECT conv_id, turn, role FROM conversations")
def zipped_arrays(spark, t):
    """Parallel arrays to rows again."""
    parts = t("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("x"))
    return build.zipped(parts.select("conv_id", F.transform("x", lambda x: x["turn"]).alias("turn"), F.transform("x", lambda x: x["role"]).alias("role")), "turn", "role")


@query("SELECT DISTINCT source AS source_id, lang || (doc_id % 7) AS code FROM documents")
def glyph_codes(spark, t):
    """Codes of glyph templates in texts."""
    raw = F.concat(F.lit("a {{SKchar|"), "lang", (F.col("doc_id") % 7).cast("string"), F.lit("}} b {{skchar2 | "), "lang", (F.col("doc_id") % 7).cast("string"), F.lit("}}"))
    return build.used_codes(t("documents").select(F.col("source").alias("source_id"), raw.alias("text")))


@query("SELECT event_id::VARCHAR AS code, CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN 'second' ELSE '〔未识别字' || event_id || '〕' END AS value, CASE event_id % 3 WHEN 0 THEN 'primary' WHEN 1 THEN 'fallback' ELSE 'placeholder' END AS resolution FROM events")
def glyph_lines(spark, t):
    """Rows of a module's table."""
    k = F.col("event_id")
    line = F.when(k % 3 == 0, F.format_string('["%d"] = { "%s", "x" },', k, F.col("event_type"))).when(k % 3 == 1, F.format_string('["%d"] = { "", "second" },', k)).otherwise(F.format_string('["%d"] = "",', k))
    return extract.glyph_table(t("events").select(line.alias("line")))


@query("SELECT source, string_agg(lang || '=' || n, ',' ORDER BY lang) AS kinds FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) GROUP BY source")
def kind_counts(spark, t):
    """How many of each kind, for each source."""
    out = build.counted(t("documents"), ["source"], "lang")
    return out.select("source", F.array_join(F.transform(F.map_entries("kinds"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ",").alias("kinds"))


@query("SELECT n_nationkey::BIGINT AS n, CASE WHEN n_regionkey = 0 THEN '原典' WHEN n_nationkey = 7 THEN '经文' ELSE n_name END AS speaker, CASE WHEN n_nationkey = 7 THEN 'quoted_core' WHEN n_regionkey = 0 THEN 'core_text' WHEN n_regionkey = 1 THEN 'commentary' ELSE 'lineage' END AS role FROM nation WHERE n_regionkey > 0 OR n_nationkey <> 7")
def default_speakers(spark, t):
    """C10."""
    n = t("nation").where("n_regionkey > 0 or n_nationkey <> 7")
    source = F.when(F.col("n_nationkey") == 7, "commentary-suwen-wangbing").otherwise("x")
    layer = F.when(F.col("n_regionkey") == 0, "core").when(F.col("n_regionkey") == 1, "commentary").otherwise("lineage")
    name, role = extract.default_speaker(source, layer, F.concat("n_name", F.lit("（清）")))
    return n.select(F.col("n_nationkey").cast("long").alias("n"), name.alias("speaker"), role.alias("role"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '卷' || p_size WHEN 1 THEN '序' WHEN 2 THEN '' ELSE '原病篇' END AS volume FROM part")
def page_volumes(spark, t):
    """C9."""
    k = F.col("p_partkey") % 4
    leaf = F.when(k == 0, F.concat(F.lit("卷"), F.col("p_size").cast("string"))).when(k == 1, "序").when(k == 2, "附").otherwise("原病篇")
    return t("part").select("p_partkey", extract.volume_of(F.concat(F.lit("卷/"), leaf)).alias("volume"))


@query("SELECT DISTINCT source AS work_id, 'W-' || upper(source) AS prefix FROM documents")
def work_prefixes(spark, t):
    """G5."""
    return t("documents").select(F.col("source").alias("work_id")).distinct().select("work_id", segment.work_prefix(F.concat(F.lit("w  "), "work_id", F.lit("-"))).alias("prefix"))


@query("SELECT event_id, event_type, value FROM events WHERE event_id % 2 = 0")
def json_round_trip(spark, t):
    """Records written as JSON lines and read again with their schema."""
    rows = t("events").where("event_id % 2 = 0").select("event_id", "event_type", "value")
    path = f"{shared.application_dir(spark)}/lines-{uuid.uuid4().hex[:12]}"
    readers.write_lines(rows, path)
    return readers.json_lines(spark, path, rows.schema)


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)', 1) AS title, (page_id % 5)::INT AS level FROM pages")
def proofread_levels(spark, t):
    """The proofreading level of a page, and its title."""
    raw = F.concat(F.lit('<pagequality level="'), (F.col("page_id") % 5).cast("string"), F.lit('" user="" />'), "html")
    return t("pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)", 1).alias("title"), X.proofread_level(raw).alias("level"))


@query("""SELECT p_partkey, p_name || chr(10) || 'label ' || p_brand || ' plain item' || chr(10) || 'a & b ' || p_size || ' x' AS shown FROM part""")
def wiki_stripped(spark, t):
    """The text of markup."""
    raw = F.concat(
        F.lit("<!-- no -->'\'\'"), "p_name", F.lit("'\'\'<ref name=a>no</ref>\n* [[File:x.png|no]]label "), "p_brand", F.lit(" [[plain]] [http://u item]\n| cell\n<noinclude>no</noinclude>a &amp; b -{zh:"),
        F.col("p_size").cast("string"), F.lit("-} <small>x</small>"),
    )
    return t("part").select("p_partkey", X.strip_wiki(raw).alias("shown"))


@query("""SELECT p_partkey, regexp_replace(trim(p_name), ' +', ' ', 'g') || ' ' || p_brand || '甲乙丙，' || p_size AS shown FROM part""")
def plain_cleaned(spark, t):
    """Gaps of plain text."""
    raw = F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit(" \u3000 ")), F.lit("\t"), "p_brand", F.lit(" \n 甲 乙\u3000丙 ，\n"), F.col("p_size").cast("string"), F.lit(" "))
    return t("part").select("p_partkey", X.clean_plain(raw).alias("shown"))


@query("""WITH p AS (SELECT 'r' || n_regionkey AS source_id, n_nationkey AS page_no, n_nationkey AS n, lag(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS before FROM nation),
b AS (SELECT *, CASE WHEN before IS NULL THEN '' ELSE '卷' || before END AS old, CASE WHEN before IS NULL THEN '' ELSE '篇' || before END AS older FROM p)
SELECT source_id, page_no, '前' || n AS text, old AS volume, older AS section, CASE WHEN before IS NULL THEN '' ELSE '方' || before END AS subsection, '原典' AS speaker, 'core_text' AS speaker_type FROM b UNION ALL SELECT source_id, page_no, '正' || n || '。', '卷' || n, '', '', '原典', 'core_text' FROM b UNION ALL
SELECT source_id, page_no, '黃帝問曰：甲' || n || '。', '卷' || n, '', '', '黄帝', 'dialogue' FROM b UNION ALL SELECT source_id, page_no, '岐伯曰：㾮' || n, '卷' || n, '', '', '岐伯', 'dialogue' FROM b UNION ALL SELECT source_id, page_no, '注' || n, '卷' || n, '', '', '校注', 'textual_collation' FROM b UNION ALL
SELECT source_id, page_no, '引' || n, '卷' || n, '篇' || n, '', '原文与注文混排', 'mixed' FROM b UNION ALL SELECT source_id, page_no, '按：' || n, '卷' || n, '篇' || n, '', '原典', 'core_text' FROM b UNION ALL SELECT source_id, page_no, '方文' || n || '〔原文缺字〕', '卷' || n, '篇' || n, '方' || n, '原典', 'core_text' FROM b""")
def wiki_sections(spark, t):
    """Markup to blocks; a heading holds until the next, also on later pages of its source."""
    n = F.col("n_nationkey").cast("string")
    parts = ["前", n, "\n\n== 卷", n, " ==\n{{header|x=1}}正", n, "。黃帝問曰：甲", n, "。岐伯曰：{{SKchar|12}}", n, "\n\n{{*|注", n, "}}\n\n=== 篇", n, " ===\n作者：無\n属性：引", n, "\n按：", n, "\n:;方", n, "\n方文", n, "{{?}}"]
    pages = t("nation").select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("source_id"), F.col("n_nationkey").cast("int").alias("page_no"), F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts]).alias("raw"), F.lit("core").alias("layer"))
    out = extract.blocks(pages, extract.Glyphs({"12": "㾮"}))
    return out.select("source_id", "page_no", "text", "volume", "section", "subsection", "speaker", "speaker_type")


@query("""WITH p AS (SELECT p_partkey, p_size * 90 AS n FROM part), c AS (SELECT p_partkey, n, unnest(range(0, CASE WHEN n <= 700 THEN 1 ELSE 1 + ceil((n - 700) / 630)::INT END)) AS k FROM p)
SELECT p_partkey, k::BIGINT AS place, (k * 630)::BIGINT AS start, CASE WHEN n - k * 630 <= 700 THEN n ELSE (k + 1) * 630 END::BIGINT AS "end" FROM c""")
def bounded_pieces(spark, t):
    """Texts of sentences of 90 characters, cut after the last that fits in 700."""
    text = F.repeat(F.concat(F.repeat(F.lit("x"), F.lit(89)), F.lit("。")), F.col("p_size"))
    cut = spread(t("part").select("p_partkey", "p_size")).select("p_partkey", F.posexplode(segment.pieces(text, with_text=False)).alias("place", "p"))
    return cut.select("p_partkey", F.col("place").cast("long").alias("place"), F.col("p.start").cast("long").alias("start"), F.col("p.end").cast("long").alias("end"))


@query("""WITH p AS (SELECT p_partkey, p_partkey % 4 AS a, p_partkey % 3 AS b FROM part), s AS (SELECT p_partkey, a, b, a * 3 AS x, a * 3 + 5 AS y, a * 3 + 5 + b * 3 AS z FROM p)
SELECT p_partkey, 0::BIGINT AS start, x::BIGINT AS "end", 0::BIGINT AS issues FROM s WHERE a > 0 UNION ALL SELECT p_partkey, x::BIGINT, y::BIGINT, 1::BIGINT FROM s UNION ALL SELECT p_partkey, y::BIGINT, z::BIGINT, 0::BIGINT FROM s WHERE b > 0""")
def semantic_pieces(spark, t):
    """The sentence with an issue stays apart, clean ones beside each other together."""
    k = F.col("p_partkey")
    text = F.concat(F.repeat(F.lit("甲乙。"), (k % 4).cast("int")), F.lit("丙HT丁。"), F.repeat(F.lit("戊己。"), (k % 3).cast("int")))
    cut = spread(t("part").select("p_partkey")).select("p_partkey", F.explode(segment.pieces(text, F.lit("core_text"), with_text=False)).alias("p"))
    total = F.aggregate(F.map_values("p.issues"), F.lit(0).cast("long"), lambda a, x: a + x)
    return cut.select("p_partkey", F.col("p.start").cast("long").alias("start"), F.col("p.end").cast("long").alias("end"), total.alias("issues"))


@query("""SELECT 'X-' || upper(lang) || '-' || lpad((row_number() OVER (PARTITION BY lang ORDER BY doc_id))::VARCHAR, 6, '0') AS passage_id, doc_id, (doc_id % 7 = 0) AS quarantined, sha256(CASE WHEN doc_id % 7 = 0 THEN '甲HT' || doc_id ELSE '乙' || doc_id END) AS content_sha256 FROM documents WHERE doc_id % 11 <> 0""")
def numbered_passages(spark, t):
    """Ids by work, pieces without letters dropped before they are numbered, quarantine, content hashes."""
    k = F.col("doc_id")
    text = F.when(k % 11 == 0, "……。").when(k % 7 == 0, F.concat(F.lit("甲HT"), k.cast("string"))).otherwise(F.concat(F.lit("乙"), k.cast("string")))
    blocks = t("documents").select(F.concat(F.lit("x-"), "lang").alias("work_id"), F.lit("core_text").alias("speaker_type"), "doc_id", text.alias("text"))
    return segment.segmented(blocks, ["doc_id"]).select("passage_id", "doc_id", "quarantined", "content_sha256")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 100000")
def table_round_trip(spark, t):
    """A table written in one commit, sorted by a key, and read through a filter on it."""
    path = f"{shared.application_dir(spark)}/table-{uuid.uuid4().hex[:12]}"
    readers.write_table(t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path, by=["o_orderstatus"], sort=["o_totalprice"])
    return spark.read.parquet(path).where("o_totalprice > 100000").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT p_name AS title, row_number() OVER (ORDER BY p_name)::BIGINT AS place FROM (SELECT DISTINCT '书/卷' || lpad(p_size::VARCHAR, 2, '0') AS p_name FROM part)")
def listed_pages(spark, t):
    """Pages that a listing names more than once, each once and in reading order."""
    leaf = F.concat(F.lit("书/卷"), F.lpad(F.col("p_size").cast("string"), 2, "0"))
    got = titles.in_reading_order(t("part").select(leaf.alias("title"), "p_brand"))
    return got.select("title", F.row_number().over(Window.orderBy(X.page_key(F.col("title")), "title")).cast("long").alias("place"))  # a row for each title


@query("""SELECT o_orderkey, (o_orderdate < TIMESTAMP '1996-01-01' AND o_totalprice < 150000) AS broken_date, o_orderstatus NOT IN ('F', 'O') AS broken_status FROM orders WHERE (o_orderdate < TIMESTAMP '1996-01-01' AND o_totalprice < 150000) OR o_orderstatus NOT IN ('F', 'O')""")
def value_rules(spark, t):
    """Rules of values: rows that break one, with the names of those that they break."""
    bad = readers.required(t("orders"), {"date": (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp")) | (F.col("o_totalprice") >= 150000), "status": F.col("o_orderstatus").isin("F", "O")})
    return bad.select("o_orderkey", F.array_contains("broken", "date").alias("broken_date"), F.array_contains("broken", "status").alias("broken_status"))


@query("SELECT p_partkey, 'https://w.test/index?title=' || replace(url_encode(p_name), '+', '%20') || '&oldid=' || p_size AS url FROM part")
def revision_urls(spark, t):
    """The address of a fixed revision."""
    return t("part").select("p_partkey", X.fixed_revision_url("https://w.test/index", F.col("p_name"), F.col("p_size")).alias("url"))
