import datetime
import json

import pytest
from pyspark.sql import functions as F

from quire import __main__ as cli
from quire import api
from quire.operators import build, index, segment
from tests.test_api import ALIASES, ROWS, WORKS


def test_selection_and_gates(spark):
    works = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "id string, title string")
    pick = lambda *i: spark.createDataFrame([(x,) for x in i], "id string")
    got = build.selected_works(pick("a", "b"), works, pick("a", "c"), spark.createDataFrame([("r", "q")], "id string, title string"), 2)
    assert {r.id for r in got.collect()} == {"a", "r"}
    with pytest.raises(build.GateError):
        build.selected_works(pick("a"), works, pick("a"), expected=2)
    assert build.included(works, "^[xy]$", 2).count() == 2
    with pytest.raises(build.GateError):
        build.included(works, "x", 5)
    with pytest.raises(build.GateError):
        build.gated("blocked")
    build.gated("pass")
    build.reconciled(works, 3)
    with pytest.raises(build.GateError):
        build.reconciled(works, 3, works, 1)


def test_codes_dimensions_and_counts(spark):
    texts = spark.createDataFrame([("s", "{{SKchar|12}} {{skchar2 | 9}} {{SKchar|12}}")], "source_id string, text string")
    used = build.used_codes(texts)
    assert {r.code for r in used.collect()} == {"12", "9"}
    assert [r.code for r in build.missing_codes(used, spark.createDataFrame([("12",)], "code string")).collect()] == ["9"]
    rows = spark.createDataFrame([("v", "a"), ("v", "a"), ("w", "b")], "volume string, kind string")
    dim = build.dimension(rows, ["volume"])
    assert dim.count() == 2 and build.orphans(rows, dim.where("volume = 'v'"), ["volume"]).count() == 1
    assert {r.volume: r.kinds for r in build.counted(rows, ["volume"], "kind").collect()} == {"v": {"a": 2}, "w": {"b": 1}}
    zipped = build.zipped(spark.createDataFrame([("q", ["t1", "t2"], ["u1", "u2"])], "query string, title array<string>, url array<string>"), "title", "url")
    assert [tuple(r) for r in zipped.collect()] == [("q", "t1", "u1"), ("q", "t2", "u2")]
    a, b = build.manifest({"r": rows})["r"], build.manifest({"r": rows.orderBy(F.desc("kind"))})["r"]
    assert a == b and a["rows"] == 3


def test_summaries(spark):
    blocks = spark.createDataFrame([("w", 1, "core_text", "甲甲。"), ("w", 2, "core_text", "乙HT乙。")], "work_id string, n int, speaker_type string, text string")
    done = segment.segmented(blocks, ["n"])
    per, total = build.summaries(done)
    assert total.first().asDict() == {"passages": 2, "citable": 1, "quarantined": 1, "characters": 8, "longest": 5, "works": 1} and per.count() == 1
    assert [(r.issue, r.n) for r in build.quarantine(done).collect()] == [("legacy-glyph-placeholder-ht-kt", 1)]


def test_command_line(spark, tmp_path):
    f = tmp_path
    own = api.Corpus(spark, spark.createDataFrame(ROWS, api.PASSAGE), WORKS, ALIASES)
    own.passages.write.parquet(str(f / "passages"))
    index.write_index(own.sets(), str(f / "index"), 2)
    (f / "works.json").write_text(json.dumps([{"id": w.id, "title": w.title, "author": w.author, "layer": w.layer, "targets": list(w.targets), "canon": "huangdi"} for w in WORKS]))
    (f / "aliases.json").write_text(json.dumps([{"alias": a.alias, "kind": a.kind, "canonical": a.canonical, "target_work": a.target_work} for a in ALIASES]))
    ask = lambda *a: cli.answer(spark, cli.parser().parse_args([str(f), *a]))
    got = ask("search", "--query", "治未病", "--work", "难经", "--layers", "core")
    assert [r["id"] for r in got["results"]] == ["NJ-1"] and json.dumps(got, default=str)
    assert ask("passage", "--id", "SW-1")["author"] == "佚名" and len(ask("toc", "--work", "suwen")) == 2
    assert [r["id"] for r in ask("context", "--id", "SW-1", "--after", "1")["results"]] == ["SW-1", "SW-2"]


def test_evidence_and_rendering_commands(spark, tmp_path):
    f, day = tmp_path, datetime.date(2030, 1, 1)
    tables = {
        "topics": spark.createDataFrame([("chest-pain", "M3", "胸痛", ["胸痛"], ["chest pain"]), ("ginseng", "M2", "人参", [], ["ginseng"])], "id string, default_level string, title_zh string, search_terms_zh array<string>, search_terms_en array<string>"),
        "topic_aliases": spark.createDataFrame([("chest-pain", "胸痛", "胸痛"), ("ginseng", "人参", "人参")], "topic_id string, alias string, normalized_alias string"),
        "records": spark.createDataFrame([("r1", "verified", "limited", day, "summary")], "id string, status string, confidence string, expires_at date, summary_zh string"),
        "record_topics": spark.createDataFrame([("r1", "ginseng", 0.9)], "record_id string, topic_id string, relevance double"),
        "registry": spark.createDataFrame([("cdc", 1, ["cdc.gov"])], "id string, priority int, domains array<string>"),
        "passages": spark.createDataFrame(ROWS, api.PASSAGE),
    }
    for name, df in tables.items():
        df.write.parquet(str(f / name))
    (f / "works.json").write_text(json.dumps([{"id": w.id, "title": w.title, "author": w.author, "layer": w.layer, "targets": list(w.targets)} for w in WORKS]))
    ask = lambda *a: cli.answer(spark, cli.parser().parse_args([str(f), *a]))
    assert ask("classify", "--query", "胸痛怎么办")["level"] == "M3"
    plan = ask("plan", "--query", "人参的疗效", "--as-of", "2031-01-01")
    assert plan["required"] and [q["query"] for q in plan["queries"]] == ["人参 指南 药监", "ginseng guideline systematic review"]
    assert ask("plan", "--query", "人参的疗效", "--as-of", "2025-01-01")["queries"] == [] and ask("plan", "--query", "治未病")["required"] is False
    assert [r["id"] for r in ask("lookup", "--query", "人参的疗效", "--as-of", "2025-01-01")["records"]] == ["r1"]
    packet = ask("study", "--query", "治未病", "--as-of", "2025-01-01", "--compact")
    assert packet["core"] and not any("text" in r for r in packet["core"])
    urgent = ask("study", "--query", "我现在胸痛", "--as-of", "2025-01-01")
    assert urgent["classics_deferred"] and "120" in urgent["safety_message"]
    for k, one in enumerate((packet, urgent)):
        (f / f"p{k}.json").write_text(json.dumps(one, default=str, ensure_ascii=False))
        for form in ("markdown", "html"):
            shown = ask("render", "--input", str(f / f"p{k}.json"), "--format", form)
            assert shown.startswith("#" if form == "markdown" else "<!doctype") and ("治未病" in shown if k == 0 else urgent["safety_message"] in shown)
    with pytest.raises(SystemExit):
        ask("status", "--as-of", "2025-13-01")
    blocks = spark.createDataFrame([("w", 1, "core_text", "甲乙。" * 100)], "work_id string, page_no int, speaker_type string, text string")
    blocks.write.parquet(str(f / "blocks"))
    assert ask("segment", "--blocks", str(f / "blocks"), "--output", str(f / "out"), "--max-chars", "100", "--min-chars", "10")["passages"] == 4
    with pytest.raises(ValueError):
        ask("segment", "--blocks", str(f / "blocks"), "--output", str(f / "out"), "--max-chars", "10", "--min-chars", "10")


def test_metadata_and_citable_rows(spark):
    works = spark.createDataFrame([("w", "t", ["a", "b"])], "id string, title string, targets array<string>")
    sources = spark.createDataFrame([("s", [("p1",), ("p2",)])], "id string, pages array<struct<title:string>>")
    got = build.metadata(works, works.select("id"), sources)
    assert {r.target_work for r in got["work_targets"].collect()} == {"a", "b"} and [(r.page_sequence, r.title) for r in got["source_pages"].collect()] == [(0, "p1"), (1, "p2")]
    rows = spark.createDataFrame([(1, True, True, "clean", "x"), (2, False, True, "quarantined", ""), (3, True, True, "clean", "")], "id int, citable boolean, searchable boolean, quality_status string, text string")
    assert [r.id for r in build.citable_only(rows.where("id < 3")).collect()] == [1]
    with pytest.raises(build.GateError):
        build.citable_only(rows)
    files = spark.createDataFrame([("f", "h")], "path string, sha256 string")
    assert build.manifest({"r": rows}, inputs=files)["inputs"] == {"f": "h"}


def test_index_versions(spark, tmp_path):
    own = api.Corpus(spark, spark.createDataFrame(ROWS, api.PASSAGE), WORKS, ALIASES)
    path = str(tmp_path / "i")
    index.write_index(own.sets(), path, 2)
    first = index.Index(spark, path)
    before = first.postings.count()
    index.write_index(own.sets().limit(2), path, 2)
    assert index.Index(spark, path).lengths.count() == 2 and first.postings.count() == before
    assert index.Index(spark, path).hits([]).count() == 0
    plan = index.Index(spark, path).hits(["未病"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(gram), EqualTo(gram,未病)]" in plan or "In(gram" in plan or "EqualTo(gram" in plan
