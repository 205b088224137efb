"""Retrieval, ranking and context on literal rows, and rules that must hold for any rows."""

import math

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.text import CJK_KEEP
from quire.operators import context, index, packet, query, rank, retrieve
from quire.plans import base, retrieval_queries

DOCS = [("SW-1", "素问", "不治已病治未病"), ("SW-2", "素问", "阴阳者天地之道也"), ("LS-1", "灵枢", "治病必求于本"), ("NJ-1", "难经", "上工治未病中工治已病"), ("XX-1", "治未病论", "他说")]


def sets(spark):
    return index.gram_sets(spark.createDataFrame(DOCS, "id string, title string, text string"), F.col("title"), F.col("text"), CJK_KEEP)


def slow_bm25(terms, broad=False):
    grams = lambda s: list(dict.fromkeys(s[i : i + 2] for i in range(len(s) - 1)))
    t = {d: (set(grams(a)), set(grams(b))) for d, a, b in DOCS}
    tokens = {d: len(a) + len(b) for d, (a, b) in t.items()}
    avg = sum(tokens.values()) / len(t)
    out = {}
    for d, (a, b) in t.items():
        score, hit = 0.0, False
        for term in terms:
            have = [g for g in grams(term) if g in a or g in b]
            if have and (broad or len(have) == len(grams(term))):
                hit = True
                for g in have:
                    n = sum(g in x or g in y for x, y in t.values())
                    idf = math.log((len(t) - n + 0.5) / (n + 0.5))
                    tf = 5 * (g in a) + (g in b)
                    score += (idf if idf > 0 else 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * tokens[d] / avg))
        if hit:
            out[d] = -score
    return out


@pytest.mark.parametrize("broad", [False, True])
@pytest.mark.parametrize("terms", [["治未病"], ["治未病", "阴阳"], ["未病", "治未病"], ["无此"]])
def test_bm25_counts_satisfied_groups_only(spark, broad, terms):
    s = sets(spark)
    wanted = index.groups(spark, [(0, t) for t in terms], broad)
    hits = index.scan(s, sorted({t[i : i + 2] for t in terms for i in range(len(t) - 1)}))
    got = {r.id: r["rank"] for r in index.bm25(hits, index.totals(s), wanted).collect()}
    want = slow_bm25(terms, broad)
    scanned = {r.id: r["rank"] for r in index.scan_bm25(s, [(0, t) for t in terms], broad).collect()}
    assert set(scanned) == set(want) and all(abs(scanned[d] - want[d]) < 1e-9 for d in want)
    assert set(got) == set(want) and all(abs(got[d] - want[d]) < 1e-9 for d in want)


def test_stored_index_gives_the_same(spark, tmp_path):
    s, terms = sets(spark), ["治未病"]
    index.write_index(s, str(tmp_path / "i"), 2)
    stored, wanted = index.Index(spark, str(tmp_path / "i")), index.groups(spark, [(0, t) for t in terms])
    got = {r.id: round(r["rank"], 9) for r in index.bm25(stored.hits(index.grams_of(terms)), stored.totals, wanted).collect()}
    assert got == {d: round(x, 9) for d, x in slow_bm25(terms).items()}


WORKS = [
    query.Work("core-suwen", "素问", "佚名", "core", ("suwen",)), query.Work("commentary-suwen-wang", "《素问注》", "王冰", "commentary", ("suwen",)), query.Work("core-nanjing", "难经", "佚名", "core", ("nanjing",)),
]
ALIASES = [query.Alias("素问", "work", "素问", target_work="suwen"), query.Alias("内经", "canon", "内经", canon="huangdi"), query.Alias("难经", "work", "难经", target_work="nanjing"), query.Alias("藏象", "term", "脏象")]
RULES = query.Rules.load({"schema_version": 1, "author_routes": [{"aliases": ["王冰"], "canonical": "王冰"}], "task_phrases": ["怎么说", "请问"], "filler_phrases": ["一下"], "broad_concepts": ["阴阳"], "focus_rules": [{"triggers": ["禁忌"], "terms": ["禁忌", "不可"]}], "expansions": [{"id": "e1", "triggers": ["未病"], "terms": ["治未病"], "preferred_passage_ids": ["SW-1"]}]})


def test_routes():
    r = query.infer_route("请问《素问注》怎么说", ALIASES, WORKS, RULES)
    assert r.title_work_ids == ("commentary-suwen-wang",) and r.target_works == () and not r.hard_scope
    r = query.infer_route("素问和难经，不看王冰", ALIASES, WORKS, RULES)
    assert r.target_works == ("suwen", "nanjing") and r.excluded_work_ids == ("commentary-suwen-wang",) and r.hard_scope
    r = query.infer_route("不要素问", ALIASES, WORKS, RULES)
    assert r.excluded_work_ids == ("core-suwen", "commentary-suwen-wang") and r.relaxed().excluded_work_ids == r.excluded_work_ids
    assert query.infer_route("王冰", ALIASES, WORKS, RULES).author_groups == (("王冰", ("commentary-suwen-wang",)),)
    with pytest.raises(ValueError):
        query.Rules.load({"schema_version": 2})


def test_intents_and_plans():
    empty = retrieve.Route()
    mode = lambda q, r=empty: query.infer_intent(q, r, RULES).mode
    assert [mode(q) for q in ("看看前后文", "比较两者", "原文在哪里", "注家的看法", "治未病")] == ["context", "compare", "quote_lookup", "physician", "study"]
    assert query.infer_intent("阴阳", empty, RULES).scope_too_broad and not query.infer_intent("阴阳", retrieve.Route(target_works=("suwen",)), RULES).scope_too_broad
    p = query.build_plan("请问“上工治未病”一下", empty, ALIASES, RULES)
    assert p.quoted == ["上工治未病"] and p.terms[0] == "上工治未病" and "治未病" in p.terms and p.preferred == []
    p = query.build_plan("未病与养生", empty, ALIASES, RULES, supported=lambda f: f == "养生")
    assert p.expansions == ["e1"] and p.focus == ["养生"] and p.topics == ["治未病"]
    assert query.build_plan("x", empty, ALIASES, RULES, terms="藏象, a").terms == ["脏象"]
    groups = query.comparison_groups(query.infer_route("比较素问难经", ALIASES, WORKS, RULES), query.build_plan("比较素问难经", query.infer_route("比较素问难经", ALIASES, WORKS, RULES), ALIASES, RULES), WORKS)
    assert [g["work_ids"] for g in groups] == [["core-suwen"], ["core-nanjing"]]


def test_scope_never_escapes(spark):
    works = spark.createDataFrame([(w.id, "huangdi", w.layer, w.author, list(w.targets)) for w in WORKS], "id string, canon string, layer string, author string, targets array<string>")
    ids = lambda route, scope=retrieve.Scope(): {r.id for r in works.where(retrieve.work_filter(route, scope)).collect()}  # noqa: B008, E731
    assert ids(retrieve.Route(target_works=("suwen",))) == {"core-suwen", "commentary-suwen-wang"}
    assert ids(retrieve.Route(), retrieve.Scope(work="素问", layers=("core",))) == {"core-suwen"}
    assert ids(retrieve.Route(title_work_ids=("commentary-suwen-wang",), target_works=("nanjing",), compare_sources=True)) == {"commentary-suwen-wang", "core-nanjing"}
    assert ids(retrieve.Route(excluded_work_ids=("core-suwen",)), retrieve.Scope(author="佚")) == {"core-nanjing"} and ids(retrieve.Route(canons=("wenbing",))) == set()


def candidates(spark):
    rows = [(i, w, k, "core" if w.startswith("core") else "commentary", t, b, -1.0 * k) for k, (i, w, t, b) in enumerate([("SW-1", "core-suwen", "素问", "是故圣人不治已病治未病，不治已乱治未乱，此之谓也，夫病已成而后药之。"), ("SW-2", "core-suwen", "素问", "是故圣人不治已病治未病，不治已乱治未乱，此之谓也，夫病已成而后药之！"), ("NJ-1", "core-nanjing", "难经", "经言上工治未病，中工治已病者，何谓也。"), ("C-1", "commentary-x", "注", "未病"), ("C-2", "commentary-x", "治未病篇", "其他文字在此处并不相干甲乙丙丁")])]
    return spark.createDataFrame(rows, "id string, work_id string, sequence int, layer string, place string, text string, rank double")


def test_tiers_scores_and_reasons(spark):
    got = {r.id: r for r in rank.scored(candidates(spark), ["治未病"], keep=CJK_KEEP).collect()}
    assert (got["SW-1"].tier, got["NJ-1"].tier, got["C-2"].tier) == ("A", "A", "B") and got["C-1"].reason == "too-short" and not got["C-1"].useful
    assert got["SW-1"].score == 0 + 80 + 18 + 3 + 3.5 + 4 and got["SW-1"].useful
    quoted = {r.id: r for r in rank.scored(candidates(spark), ["治未病"], quoted=("上工治未病",), keep=CJK_KEEP).collect()}
    assert quoted["NJ-1"].useful and quoted["SW-1"].reason == "quoted-phrase-not-found"


def test_choice_respects_limits_duplicates_and_groups(spark):
    rows = [r.asDict() | {"speaker_type": "core_text"} for r in rank.scored(candidates(spark), ["治未病"], keep=CJK_KEEP).collect()]
    chosen, out = rank.choose(rows, [])
    assert [r["id"] for r in chosen] == ["SW-2", "NJ-1", "C-2"]
    assert out["near_duplicate"] == 1 and len({r["id"] for r in chosen}) == len(chosen) and sum(r["layer"] == "core" for r in chosen) <= 2
    only = rank.choose(rows, [{"label": "注", "kind": "work", "work_ids": ["commentary-x"]}], total=1)[0]
    assert [r["id"] for r in only] == ["C-2"]
    report = rank.coverage_report([{"work_ids": ["commentary-x"]}, {"work_ids": ["zz"]}, {"work_ids": ["core-nanjing"]}], rows, only)
    assert [g["status"] for g in report] == ["matched", "not-found", "not-displayed"]


def test_excerpt_is_a_substring():
    text = "甲乙丙。" * 30 + "上工治未病，中工治已病。" + "丁戊己。" * 30
    a, b = rank.excerpt(text, "治未病")
    assert "治未病" in text[a:b] and 64 <= b - a <= 260
    long = "甲，" * 300 + "治未病" + "，乙" * 300
    a, b = rank.excerpt(long, "治未病")
    assert "治未病" in long[a:b] and b - a <= 320 and rank.excerpt("", "x") == (0, 0)


def test_context_window(spark):
    rows = spark.createDataFrame([("w", s) for s in (1, 2, 4, 5, 9)] + [("v", 4)], "work_id string, sequence int")
    got = context.context(rows, spark.createDataFrame([("w", 4), ("w", 7)], "work_id string, sequence int"), "work_id", "sequence", 2, 1).collect()
    assert sorted((r.sequence, r.context_role) for r in got) == [(1, "before"), (2, "before"), (4, "anchor"), (5, "after")]
    with pytest.raises(ValueError):
        context.context(rows, rows, "work_id", "sequence", -1)


def test_packets_keep_the_budget(spark):
    rows = [(1, 1, "a", "core", "results", "x" * 600, False), (1, 2, "b", "core", "results", "x" * 2500, False), (1, 3, "c", "commentary", "results", "x" * 900, True), (1, 4, "d", "core", "alternative", "x" * 1000, False), (2, 1, "e", "core", "results", "x" * 3000, True)]
    got = {r["query"]: r for r in packet.packets(spark.createDataFrame(rows, "query int, place int, id string, layer string, channel string, text string, anchor boolean")).collect()}
    assert (got[1].core, got[1].extension, got[1].alternatives, got[1].used, got[1].left_out) == (["a"], ["c"], ["d"], 2500, 1)
    assert got[2].used == 0 and got[2].clarification == "anchor-over-budget"
    with pytest.raises(ValueError):
        packet.checked_budget(499)


def test_rendering_of_packets():
    item = {"id": "<b>", "title": "<b>", "author": "a&b", "place": "", "quote": "x\ny", "url": 'https://u/"', "speaker_type": "quoted_core", "context_role": "before"}
    plan = {"required": True, "queries": []}
    level = lambda x: {"classification": {"level": x}, "records": [], "online_search_plan": plan}
    one = {"query": "<q>", "evidence": level("M0"), "safety_first": False, "safety_message": "", "core": [item], "extension": [], "alternatives": [], "needs_clarification": {"required": False, "reason": "", "lacking": []}}
    page, text = packet.markup(one), packet.markdown(one)
    assert "<b>" not in page and "&lt;b&gt;" in page and "a&amp;b" in page and "<q>" not in page
    assert "> x\n> y" in text and packet.QUOTED_CORE in text and packet.ROLES["before"] in text and "现代医学" not in text
    urgent = one | {"core": [], "evidence": level("M3"), "safety_first": True, "safety_message": "call now", "classics_deferred": True}
    assert packet.markdown(urgent).index("call now") < packet.markdown(urgent).index(packet.DEFERRED) and packet.SEARCH_ONLINE in packet.rendered(urgent, "html")
    lost = one | {"core": [], "needs_clarification": {"required": True, "reason": "incomplete-comparison", "lacking": ["甲"]}}
    assert "甲" in packet.markdown(lost) and packet.NOTHING not in packet.markdown(lost) and packet.NOTHING in packet.markdown(one | {"core": []})


def test_a_stored_index_takes_the_grams_of_a_text_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def seen(grams):
        made.add(1)
        return grams

    s = sets(spark).withColumn("body_grams", seen("body_grams"))
    index.write_index(s, str(tmp_path / "i"))
    assert made.value == len(DOCS)
    stored = index.Index(spark, str(tmp_path / "i"))
    assert sorted(map(tuple, stored.postings.collect())) == sorted(map(tuple, index.exploded(sets(spark)).select(stored.postings.columns).collect()))
    assert sorted(map(tuple, stored.lengths.collect())) == sorted(map(tuple, index.lengths(sets(spark)).collect()))
    index.write_index(sets(spark).limit(0), str(tmp_path / "none"))
    assert index.Index(spark, str(tmp_path / "none")).postings.count() == 0


def test_only_texts_with_cjk_meet_the_tables(spark):
    texts = ["Ça VA, ok", "問 五藏 Ab", "", None, "İ欬x", "痺鬬 9"]
    frame = spark.createDataFrame([(x,) for x in texts], "x string")
    plain = F.regexp_replace(X.replaced(F.lower(F.translate("x", X.QUERY_FROM, X.QUERY_TO)), X.QUERY_OVERRIDES), X.LETTER_KEEP, "")
    assert all(a == b for a, b in frame.select(X.normalize_query(F.col("x"), X.LETTER_KEEP), plain).collect())
    assert all(0x3400 <= ord(c) <= 0x9FFF for c in X.QUERY_FROM + "".join(a for a, _ in X.QUERY_OVERRIDES))


def test_scores_need_no_bigrams_of_the_text(spark):
    rows = [(k, "w", k, "core", place, text, 0.0) for k, (place, text) in enumerate([("素问", "阳"), ("阳", "阴阳者"), ("", ""), ("难经", "治未病已病"), ("治", None), ("a", "未病 治未")])]
    out = rank.scored(spark.createDataFrame(rows, "id int, work_id string, sequence int, layer string, place string, text string, rank double"), ["阳", "治未病"])
    assert "regexp_extract_all" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r.id: [(d.coverage, d.matched, d.of) for d in r.details] for r in out.collect()}
    assert got[0] == [(1.0, 1, 1), (0.0, 0, 2)] and got[1] == [(1.0, 1, 1), (0.0, 0, 2)]  # a single character only as a whole text
    assert got[2] == got[4] == [(0.0, 0, 1), (0.0, 0, 2)] and got[3] == got[5] == [(0.0, 0, 1), (1.0, 2, 2)]


def test_whole_texts_are_searched_only_where_it_matters(spark):
    texts = ["未病的时候治未，见上", "上工治未病见上见上", "阳气者若天与日乎", None, "上工何也？", "上工治未病" * 9 + "何也？", "三两五钱零半斤八两", "方见上篇某某某某", "一云某某某某某某", "一二某某某某某某"]
    rows = [(k, "w", k, "x", "", t, 0.0) for k, t in enumerate(texts)]
    out = rank.scored(spark.createDataFrame(rows, "id int, work_id string, sequence int, layer string, place string, text string, rank double"), ["治未病", "阳"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "(length(text#" in plan and "< 32) AND RLIKE(trim(text#" in plan  # the pattern goes over the whole text, so the length is asked first
    assert "AND RLIKE(_body#" in plan and "RLIKE(_body#" not in plan.replace("AND RLIKE(_body#", "")  # as is the first character
    assert "AND Contains(_body#" in plan  # and the grams before the term
    got = {r.id: r for r in out.collect()}
    assert [got[k].details[0].exact_body for k in range(6)] == [False, True, False, None, False, True] and got[0].details[0].coverage == 1.0
    assert [got[k].details[1].exact_body for k in range(4)] == [False, False, True, None]
    assert [got[k].reason for k in range(10)] == [None, None, None, None, "too-short", None, "quantity-only", "reference-only", "reference-only", None]
    assert got[4].score == -133.0 and got[5].score == 105.0  # 15 off for a short question alone


def test_texts_of_a_pool_are_not_dealt_out(spark, small):
    plan = retrieval_queries._pool(spark, base.Tables(spark, small))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
