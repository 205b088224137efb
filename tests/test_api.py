"""Searches and packets end to end, on a small corpus of literal passages."""

import datetime

import pytest

from quire import api
from quire.operators import index
from quire.operators.query import Alias, Rules, Work

WORKS = [Work("core-suwen", "素问", "佚名", "core", ("suwen",)), Work("core-nanjing", "难经", "佚名", "core", ("nanjing",)), Work("commentary-suwen-wang", "素问注", "王冰", "commentary", ("suwen",)), Work("commentary-nanjing-hua", "难经本义", "滑寿", "commentary", ("nanjing",))]
ROWS = [
    ("SW-1", "core-suwen", 1, "四气调神", "core_text", "是故圣人不治已病治未病，不治已乱治未乱，此之谓也。夫病已成而后药之，乱已成而后治之，不亦晚乎。"),
    ("SW-2", "core-suwen", 2, "四气调神", "core_text", "阴阳者，天地之道也，万物之纲纪，变化之父母，生杀之本始，神明之府也。治病必求于本。"),
    ("SW-3", "core-suwen", 4, "金匮真言", "core_text", "黄帝问曰：天有八风，经有五风，何谓？岐伯对曰：八风发邪，以为经风，触五藏，邪气发病。"),
    ("NJ-1", "core-nanjing", 1, "七十七难", "core_text", "经言上工治未病，中工治已病者，何谓也？然：所谓治未病者，见肝之病，则知肝当传之与脾。"),
    ("WB-1", "commentary-suwen-wang", 1, "四气调神", "commentary", "王冰注：知之至也，治未病者，未病而先治之，防微杜渐，此圣人之所以为圣也，学者宜详之。"),
    ("HS-1", "commentary-nanjing-hua", 1, "七十七难", "commentary", "滑寿注：治未病者，谓见肝之病先实其脾，使邪无所入，此上工之治也，中工则但治其已病。"),
]
ALIASES = [Alias("素问", "work", "素问", target_work="suwen"), Alias("难经", "work", "难经", target_work="nanjing")]
RULES = Rules.load({"schema_version": 1, "task_phrases": ["怎么说", "原文在哪里", "请问", "比较"], "filler_phrases": ["我记得"], "broad_concepts": ["阴阳"], "author_routes": [{"aliases": ["王冰"], "canonical": "王冰"}, {"aliases": ["滑寿"], "canonical": "滑寿"}]})


@pytest.fixture(scope="module")
def corpus(spark):
    return api.Corpus(spark, spark.createDataFrame(ROWS, api.PASSAGE).persist(), WORKS, ALIASES, RULES)


@pytest.fixture(scope="module")
def known(spark):
    d = datetime.date
    return api.Evidence(
        spark.createDataFrame([("chest-pain", "M3"), ("ginseng", "M2")], "id string, default_level string"),
        spark.createDataFrame([("chest-pain", "胸痛", "胸痛"), ("ginseng", "人参", "人参")], "topic_id string, alias string, normalized_alias string"),
        spark.createDataFrame([("r1", "verified", "limited", d(2030, 1, 1))], "id string, status string, confidence string, expires_at date"),
        spark.createDataFrame([("r1", "ginseng", 0.9)], "record_id string, topic_id string, relevance double"),
        spark.createDataFrame([("cdc", 1, ["cdc.gov"])], "id string, priority int, domains array<string>"),
    )


def ids(got):
    return [r["id"] for r in got["results"]]


def test_search_finds_originals_first(corpus):
    got = corpus.search("治未病")
    assert ids(got)[0] in ("SW-1", "NJ-1") and set(ids(got)) == {"SW-1", "NJ-1", "WB-1", "HS-1"} and got["needs_clarification"]["reason"] == ""
    for r in got["results"]:
        assert r["quote"] == r["text"][r["quote_start"] : r["quote_end"]] and r["match"]["tier"] == "A"
    assert next(r for r in got["results"] if r["id"] == "SW-1")["next_id"] == "SW-2"


def test_scope_and_exclusion(corpus):
    assert {r["work_id"] for r in corpus.search("素问 治未病")["results"]} <= {"core-suwen", "commentary-suwen-wang"}
    assert "WB-1" not in ids(corpus.search("治未病，不看王冰"))
    assert ids(corpus.search("治未病", layers="core", work="难经")) == ["NJ-1"]
    assert ids(corpus.search("“上工治未病”原文在哪里")) == ["NJ-1"]


def test_comparison_and_coverage(corpus):
    got = corpus.search("比较王冰和滑寿 治未病")
    assert set(ids(got)) == {"WB-1", "HS-1"} and [g["status"] for g in got["scope_coverage"]] == ["matched", "matched"]
    got = corpus.search("比较王冰和滑寿 八风发邪")
    assert got["needs_clarification"]["required"]


def test_fallback_and_clarification(corpus):
    got = corpus.search("我记得难经 八风发邪")
    assert got["route_resolution"]["mode"] == "relaxed-fallback" and ids(got) == ["SW-3"]
    assert corpus.search("只看难经 八风发邪")["needs_clarification"]["reason"] == "no-direct-match"
    broad = corpus.search("阴阳")
    assert len(broad["results"]) == 1 and broad["needs_clarification"]["reason"] == "scope-too-broad"
    assert corpus.search("完全不在其中之语")["needs_clarification"]["reason"] == "no-direct-match"


def test_stored_index_gives_the_same_results(corpus, spark, tmp_path):
    index.write_index(corpus.sets(), str(tmp_path / "i"), 2)
    other = api.Corpus(spark, corpus.passages, WORKS, ALIASES, RULES, stored=index.Index(spark, str(tmp_path / "i")))
    a, b = corpus.search("治未病"), other.search("治未病")
    assert ids(a) == ids(b) and [round(r["score"], 6) for r in a["results"]] == [round(r["score"], 6) for r in b["results"]]


def test_passage_context_toc(corpus):
    assert corpus.passage("SW-2")["title"] == "素问" and corpus.passage("x")["error"] == "passage-not-found"
    got = corpus.context("SW-2", 1, 1)
    assert [(r["id"], r["context_role"]) for r in got["results"]] == [("SW-1", "before"), ("SW-2", "anchor"), ("SW-3", "after")]
    assert [(r["place"], r["n"]) for r in corpus.toc("素问")] == [("四气调神", 2), ("金匮真言", 1)] == [(r["place"], r["n"]) for r in corpus.toc("core-suwen")]


def test_evidence(known):
    got = known.assess("人参的疗效", "2025-01-01")
    assert got["classification"]["level"] == "M2" and [r["id"] for r in got["records"]] == ["r1"] and not got["lookup"]["needs_online"] and got["records"][0]["labels"]["confidence"] == "有限"
    assert known.assess("人参最新研究", "2025-01-01")["lookup"]["needs_online"]
    assert known.source_check("https://www.cdc.gov/a")["approved"] and not known.source_check("http://cdc.gov")["approved"]
    assert known.status("2031-01-01") == {"records": 1, "fresh": 0, "stale": 1}


def test_study_packets(corpus, known):
    got = api.study(corpus, known, "治未病", "2025-01-01", 500)
    assert got["characters_used"] <= 500 and {r["id"] for r in got["core"]} and not got["safety_first"]
    urgent = api.study(corpus, known, "现在胸痛怎么办", "2025-01-01")
    assert urgent["safety_first"] and urgent["core"] == [] == urgent["extension"]
    anchored = api.study(corpus, known, "x", "2025-01-01", anchor_id="SW-2")
    assert [r["id"] for r in anchored["core"]] == ["SW-1", "SW-2", "SW-3"]
    assert api.study(corpus, known, "x", "2025-01-01", anchor_id="no")["needs_clarification"]["reason"] == "anchor-not-found"
    with pytest.raises(ValueError):
        api.study(corpus, known, "x", "2025-01-01", 100)
