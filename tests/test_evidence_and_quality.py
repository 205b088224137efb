import datetime

import pytest
from pyspark.sql import functions as F

from quire.operators import evidence, quality, titles
from quire.sources import readers, schemas

TOPICS = [("chest-pain", "M3"), ("ginseng", "M2"), ("qi", "M1")]
ALIASES = [("chest-pain", "胸痛", "胸痛"), ("ginseng", "人参", "人参"), ("qi", "气", "气")]


def classified(spark, *texts):
    q = spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")
    topics, aliases = spark.createDataFrame(TOPICS, "id string, default_level string"), spark.createDataFrame(ALIASES, "topic_id string, alias string, normalized_alias string")
    return evidence.classify(q, topics, aliases)


@pytest.mark.parametrize(
    ("text", "level", "confidence"),
    [("我现在胸痛", "M3", "high"), ("胸痛", "M3", "high"), ("胸痛原文出处", "M0", "medium-high"), ("胸痛原文，怎么办", "M3", "high"), ("人參的疗效", "M2", "medium-high"), ("人参", "M2", "medium-high"), ("气与现代医学", "M1", "medium-high"), ("氣", "M1", "medium-high"), ("治未病", "M0", "medium")],
)
def test_levels(spark, text, level, confidence):
    r = classified(spark, text).first()
    assert (r.level, r.confidence) == (level, confidence) and r.modern_layer_required == (level != "M0") and r.safety_must_precede_retrieval == (level == "M3")


def test_lookup_freshness_and_online_need(spark):
    d = datetime.date
    records = spark.createDataFrame([("r1", "verified", "higher", d(2030, 1, 1)), ("r2", "verified", "limited", d(2020, 1, 1)), ("r3", "draft", "higher", d(2030, 1, 1))], "id string, status string, confidence string, expires_at date")
    bridge = spark.createDataFrame([("r1", "qi", 0.5), ("r1", "ginseng", 0.9), ("r2", "qi", 0.8), ("r3", "qi", 1.0)], "record_id string, topic_id string, relevance double")
    wanted = spark.createDataFrame([(0, "qi"), (1, "ginseng")], "query_id long, topic_id string")
    as_of = F.lit("2025-01-01").cast("date")
    every = evidence.lookup(wanted, records, bridge, as_of, include_stale=True)
    assert [(r.query_id, r.id, r.match_relevance, r.fresh) for r in evidence.in_order(every).collect()] == [(0, "r2", 0.8, False), (0, "r1", 0.5, True), (1, "r1", 0.9, True)]
    assert [r.id for r in evidence.lookup(wanted, records, bridge, as_of).collect()] == ["r1", "r1"]
    got = {r.query_id: r for r in evidence.needs_online(classified(spark, "气", "人参", "最新研究"), wanted, every).collect()}
    assert got[0].needs_online and got[0].stale_records == 1 and not got[1].needs_online and not got[2].needs_online
    drafts = records.unionByName(spark.createDataFrame([("r4", "draft", "higher", d(2020, 1, 1))], records.schema))
    s = evidence.status(drafts, as_of).first()
    assert (s.records, s.fresh, s.stale) == (4, 1, 1)  # an expired draft is not stale
    assert tuple(evidence.status(records.limit(0), as_of).first()) == (0, 0, 0)


def test_allow_list(spark):
    registry = spark.createDataFrame([("cdc", 1, ["cdc.gov"]), ("gov", 2, ["gov"])], "id string, priority int, domains array<string>")
    urls = ["https://www.cdc.gov/x", "https://cdc.gov", "http://cdc.gov", "https://example.com", "https://notcdc.gov", "https://evil.com/cdc.gov", "bad"]
    got = {r.url: r.source_id for r in evidence.approved(spark.createDataFrame([(u,) for u in urls], "url string"), registry).collect()}
    assert got == {urls[0]: "cdc", urls[1]: "cdc", urls[2]: None, urls[3]: None, urls[4]: "gov", urls[5]: None, urls[6]: None}


def test_nearest_rank_rounds_half_to_even(spark):
    for values, f, want in (([1, 2], 0.5, 1), ([1, 2, 3, 4], 0.5, 3), ([5], 0.95, 5), ([4, 1, 3, 2, 2], 0.95, 4)):
        df = spark.createDataFrame([("k", float(v)) for v in values] + [("k", None)], "k string, v double")
        assert df.agg(quality.nearest_rank(F.col("v"), f)).first()[0] == want
        assert quality.nearest_ranks(df, ["k"], "v", (f,)).first().v == want
        assert quality.nearest_ranks(df, [], "v", (f,)).first().v == want


def test_gate_and_links(spark):
    checks = lambda *rows: quality.gate(spark.createDataFrame(rows, "name string, passed boolean, blocking boolean")).first()
    assert checks(("a", True, True)).status == "pass" and checks(("a", False, False), ("b", True, True)).status == "pass-with-warnings"
    assert tuple(checks(("b", False, True), ("a", False, False))) == ("blocked", ["a", "b"])
    rows = spark.createDataFrame([("w", 1, "p1", None), ("w", 2, "p2", "p1"), ("w", 3, "p3", "p1")], "w string, n int, id string, prev string")
    assert [r.id for r in quality.broken_links(rows, "w", "n", "id", "prev").collect()] == ["p3"]


def test_discovery_and_redirects(spark):
    queries = spark.createDataFrame([("w", 1, "傷寒論"), ("w", 2, "伤寒")], "work_id string, query_no int, query string")
    found = spark.createDataFrame([("傷寒論", "伤寒论"), ("傷寒論", "伤寒论注"), ("伤寒", "别的伤寒")], "query string, title string")
    got = titles.discover(queries, found).orderBy("place").collect()
    assert [(r.title, r.score, r.status) for r in got] == [("伤寒论", 100.0, "match"), ("伤寒论注", 90.0, "match")]
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")], "name string, to string")
    wanted = spark.createDataFrame([("a",), ("c",), ("x",)], "name string")
    assert {r.name: r.target for r in titles.resolved(links, wanted).collect()} == {"a": "c", "c": "c", "x": "y"}
    chain = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(25)], "name string, to string").coalesce(1)
    start = spark.createDataFrame([("n0",)], "name string").coalesce(1)
    assert titles.resolved(chain, start).first().target == "n25"
    with pytest.raises(ValueError, match="redirects"):
        titles.resolved(chain, start, most=5)
    numbers = spark.range(103).withColumn("v", 1000 - F.col("id"))
    got = titles.batched(numbers, "v", 10).collect()
    assert {r.id: r.batch for r in got} == {k: (102 - k) // 10 for k in range(103)}


def test_sources_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a1", "甲", "work", None, "suwen", None), ("", "乙", "bad", None, None, "huangdi")], schemas.ALIAS)
    readers.write_lines(rows, str(tmp_path / "j"), "kind")
    back = readers.json_lines(spark, str(tmp_path / "j"), schemas.ALIAS)
    assert back.count() == 2 and {tuple(r.broken) for r in readers.required(back, schemas.alias_rules()).collect()} == {("kind", "alias")}
    readers.write_table(rows, str(tmp_path / "t"), sort=["alias"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    (tmp_path / "x.txt").write_text("甲\n乙")
    assert readers.whole_texts(spark, str(tmp_path / "x.txt")).first().text == "甲\n乙"
    (tmp_path / "d.json").write_text('{\n"alias": "z",\n"kind": "term"}')
    assert readers.json_document(spark, str(tmp_path / "d.json"), schemas.ALIAS).first().alias == "z"
    assert readers.file_hashes(spark, str(tmp_path / "x.txt")).first().length == 7
    for s in (schemas.MANIFEST, schemas.BLOCK, schemas.PASSAGE, schemas.EVIDENCE):
        assert spark.createDataFrame([], s).count() == 0


def test_safety_and_searches(spark):
    r = classified(spark, "我现在胸痛").first()
    assert r.safety_message == evidence.SAFETY[False] and classified(spark, "气").first().safety_message is None
    own = spark.range(1).select(evidence.safety_message(F.array(F.lit(evidence.SELF_HARM)), F.lit("M3")), evidence.safety_message(F.lit(None).cast("array<string>"), F.lit("M3"))).first()
    assert tuple(own) == (evidence.SAFETY[True], evidence.SAFETY[False])
    known = spark.createDataFrame([("chest-pain", "胸痛", ["胸痛 急救"], ["chest pain"]), ("ginseng", "人参", [], []), ("qi", "气", [], ["qi"])], "id string, title_zh string, search_terms_zh array<string>, search_terms_en array<string>")
    found = classified(spark, "人参与气的疗效", "气")
    covered = spark.createDataFrame([(0, "ginseng"), (1, "qi")], "query_id long, topic_id string")
    need = lambda *x: spark.createDataFrame(list(enumerate(x)), "query_id long, needs_online boolean")
    plan = lambda *x: [(r.query_id, r["query"]) for r in evidence.online_plan(evidence.planned_topics(found, known, covered, need(*x))).orderBy("query_id", "place").collect()]
    m2 = ["气 指南 药监", "qi guideline systematic review"]
    assert plan(False, False) == [(0, q) for q in m2]
    assert plan(True, True) == [(0, q) for q in ["人参 指南 药监", "人参 guideline systematic review", *m2]] + [(1, "气"), (1, "qi")]


def test_violations(spark):
    records = spark.createDataFrame([("r1", "s", 0, 1, "o", "https://a.x.org/1", "h"), ("r1", "s", 0, 1, "o", "https://x.org", "h"), ("r2", "s", 2, 1, "p", "https://y.org", "h"), ("r3", "t", 0, 1, "o", "https://x.org", "h")], "id string, source_id string, verified_at int, expires_at int, source_organization string, url string, source_content_sha256 string")
    registry = spark.createDataFrame([("s", "o", ["x.org"])], "id string, organization string, domains array<string>")
    bridge = spark.createDataFrame([("r1", "a", 0.5), ("r1", "a", 0.5), ("r2", "b", 2.0)], "record_id string, topic_id string, relevance double")
    topics, aliases = spark.createDataFrame([("a",), ("a",)], "id string"), spark.createDataFrame([("a", "x"), ("a", "x")], "topic_id string, alias string")
    audit = spark.createDataFrame([("r1", "https://a.x.org/1", "h", "s", 200), ("r2", "https://y.org", "h", "s", 404), ("r9", "u", "h", "s", 200), ("r9", "u", "h", "s", 200)], "record_id string, url string, sha256 string, source_id string, http_status int")
    got = {(r["check"], r["id"]) for r in evidence.violations(records, bridge, registry, topics, aliases, audit).collect()}
    assert got == {
        ("duplicate-record", "r1"), ("duplicate-topic", "a"), ("duplicate-link", "r1"), ("unknown-topic", "r2"), ("no-topic", "r3"), ("unknown-source", "r3"), ("expires-before-verified", "r2"), ("relevance-out-of-range", "r2"),
        ("duplicate-alias", "a"), ("organization-mismatch", "r2"), ("domain-not-approved", "r2"), ("audited-twice", "r9"), ("not-audited", "r3"), ("audit-of-no-record", "r9"), ("audit-mismatch", "r1"), ("audit-mismatch", "r2"),
    }
    assert evidence.violations(records.limit(0), bridge.limit(0), registry, topics.limit(1), aliases.limit(1), audit.limit(0)).count() == 0


def test_corpus_checks(spark):
    pages = spark.createDataFrame(
        [("s", 1, "书/卷一", None, ["Category:25%"], True, "== a ==\n<pagequality level='1'>\n=b=", "x"), ("s", 2, "书/卷一", None, ["Category:9%"], True, "t", "x"), ("s", 3, "书/卷二", None, None, False, "== c ==", "x"), ("u", 1, "p", "书/卷三", [], True, "", "x")],
        "source_id string, page_no int, title string, parent_title string, categories array<string>, include boolean, raw string, raw_sha256 string",
    )
    m = quality.raw_metrics(pages, most=2)
    s = m.where("source_id = 's'").first()
    assert (s.included, s.hash_mismatches, s.headings, s.volumes, s.levels, s.categories, s.mismatch_titles) == (2, 3, 2, 1, {"1": 1}, {"25%": 1}, ["书/卷一", "书/卷一"])
    expected = spark.createDataFrame([("s", "volume", 2)], "source_id string, kind string, minimum_accepted int")
    assert {(r.source_id, r.kind, r.observed, r.status) for r in quality.structure(m, expected).collect()} == {("s", "volume", 1, "fail"), ("u", "nonempty-corpus", 1, "pass")}
    layers = spark.createDataFrame([("s", "core"), ("u", "core")], "source_id string, layer string")
    assert {r.source_id: len(r.reasons) for r in quality.upstream_blocks(m, layers).collect()} == {"s": 2, "u": 0}
    lock = quality.source_lock(layers, quality.upstream_blocks(m, layers), quality.structure(m, expected), spark.createDataFrame([("u", 5)], "source_id string, passages int"))
    assert {r.source_id: r.lock_status for r in lock.collect()} == {"s": "candidate-blocked", "u": "final"}
    texts = spark.createDataFrame([(1, "a {{b}} HT HT"), (2, "锟斤拷 KT"), (3, "<ref x>")], "n int, text string")
    issues = {r.issue: (r.blocking, r.n, r.n_citable, len(r.examples)) for r in quality.passage_issues(texts, "text", ["n"], F.col("n") < 2).collect()}
    assert issues == {"residual-wiki-template": (True, 1, 1, 1), "legacy-glyph-placeholder-ht-kt": (False, 3, 2, 2), "mojibake-keyword": (False, 1, 0, 1), "residual-html-or-pseudo-tag": (True, 1, 0, 1)}
    verdict = {r.name: r.passed for r in quality.accepted(spark.createDataFrame([("recall_at_5", 0.98), ("level", 0.5), ("author", None)], "name string, value double")).collect()}
    assert verdict == {"recall_at_5": True, "level": False, "author": False, "safety": False}
