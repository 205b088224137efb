import random
import re

import pytest
from pyspark.sql import functions as F

from quire.operators import build, extract, segment


def test_bounded_cuts():
    text = "甲" * 300 + "。”" + "乙" * 500 + "，" + "丙" * 800
    assert segment.bounded_cuts(text) == [302, 803, 1503, 1603]
    assert segment.bounded_cuts("短") == [1] and segment.bounded_cuts("") == [0]
    assert segment.bounded_cuts("ab。cd。ef", 2, 4) == [3, 6, 8]
    # A closing mark beyond the limit stays behind.
    assert segment.bounded_cuts("abc。”de", 2, 4) == [4, 7]


def test_pieces_cover_the_text(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.select("text", segment.pieces(F.col("text")).alias("p")).collect()
    for r in rows:
        assert [p["start"] for p in r.p[1:]] == [p["end"] for p in r.p[:-1]] and r.p[0]["start"] == 0 and r.p[-1]["end"] == len(r.text)
        assert all(p["end"] - p["start"] <= 700 for p in r.p)


def test_issues_stay_with_their_sentence():
    text = "甲甲。乙〔未识别字1〕乙。丙丙。丁丁。"
    got = segment.semantic_pieces(text, "core_text", 1, 700)
    assert [(text[a:b], bool(i)) for a, b, i in got] == [("甲甲。", False), ("乙〔未识别字1〕乙。", True), ("丙丙。丁丁。", False)]
    assert [bool(i) for *_, i in segment.semantic_pieces(text, "dialogue", 1, 700)] == [True]


def test_segmented_numbers_links_and_quarantine(spark):
    rows = [("core-suwen", 1, "core_text", "甲甲。"), ("core-suwen", 2, "core_text", "……"), ("core-suwen", 3, "core_text", "乙HT乙。"), ("core-suwen", 4, "core_text", "丙。"), ("a b-1", 1, "core_text", "x")]
    blocks = spark.createDataFrame(rows, "work_id string, n int, speaker_type string, text string")
    done = segment.linked(segment.segmented(blocks, ["n"]), ["work_id"], ["sequence"], "passage_id", F.col("citable"))
    got = {r.passage_id: r for r in done.collect()}
    assert set(got) == {"SW-000001", "SW-000002", "SW-000003", "A-B-1-000001"}
    assert got["SW-000002"].quarantined and got["SW-000002"].previous_citable_id is None and got["SW-000002"].previous_id == "SW-000001"
    assert got["SW-000003"].previous_citable_id == "SW-000001" and got["SW-000001"].next_citable_id == "SW-000003"


def test_corrections(spark):
    p = spark.createDataFrame([("p1", "s", "韩HT 和 HT "), ("p2", "s", "x"), ("p3", "s", "aa")], "passage_id string, source_id string, text string")
    fixes = [("p1", "s", "c1", "HT ", "祗", 2), ("p2", "t", "c2", "x", "y", 1), ("p3", "s", "c3", "a", "b", 3), ("p9", "s", "c4", "a", "b", 1)]
    c = spark.createDataFrame(fixes, "passage_id string, source_id string, correction_id string, before string, after string, expected int")
    got = {r.passage_id: r for r in segment.corrected(p, c).collect()}
    assert got["p1"].text == "韩祗和 祗" and got["p1"].correction_ids == ["c1"] and got["p1"].correction_error is None
    assert got["p2"].text == "x" and "other source" in got["p2"].correction_error and "found 2" in got["p3"].correction_error
    assert [r.correction_id for r in segment.unapplied(p, c).collect()] == ["c4"]
    with pytest.raises(build.GateError, match="c4: no such passage"):
        segment.applied(p, c)
    two = p.withColumn("volume", F.lit("old"))
    fix = spark.createDataFrame([("p1", "s", "c1", "old", "new", 1, "volume"), ("p1", "s", "c2", "HT", "X", 2, "text"), ("p2", "s", "c3", "x", "y", 1, "bad")], "passage_id string, source_id string, correction_id string, before string, after string, expected int, field string")
    got = {r.passage_id: r for r in segment.corrected(two, fix, ("text", "volume")).collect()}
    assert (got["p1"].text, got["p1"].volume, got["p1"].correction_ids) == ("韩X 和 X ", "new", ["c1", "c2"]) and "no such field" in got["p2"].correction_error and got["p3"].text == "aa"
    done = segment.quarantined(segment.corrected(two, fix.where("passage_id = 'p1'"), ("text", "volume")).withColumns({"inherited": F.create_map(F.lit("k"), F.lit(1).cast("long")), "text_search": F.lit("t")}), "text")
    assert {r.passage_id: (r.quarantined, r.text_search) for r in done.collect()} == {"p1": (False, "t"), "p2": (True, ""), "p3": (True, "")}


def test_links_of_a_large_work_are_linear(spark):
    """Hardly a citable row in one work: each frame grows by a row at a time."""
    rows = spark.range(60_000).select(F.lit("w").alias("work"), F.col("id"))
    got = segment.linked(rows, ["work"], ["id"], "id", F.col("id").isin(10, 59_990)).where("previous_citable_id is not null or next_citable_id is not null").collect()
    assert sorted((r.id, r.previous_citable_id, r.next_citable_id) for r in got) == [(10, None, 59_990), (59_990, 10, None)]


def slow_cuts(text, least, most):
    """G1, by trying every place."""
    out, start = [], 0
    while len(text) - start > most:
        best = None
        for marks in (segment.FULL_STOPS, segment.PAUSES):
            ends = [k + 1 for k in range(start, start + most) if text[k] in marks]
            if ends:
                at = ends[-1]
                at += at < start + most and at < len(text) and text[at] in segment.CLOSERS
                if at >= start + least:
                    best = at
                    break
        start = best or start + most
        out.append(start)
    return out + ([len(text)] if start < len(text) or not out else [])


def test_cuts_of_random_texts():
    rng = random.Random(7)
    for _ in range(400):
        text = "".join(rng.choice("甲乙丙。，！”」、") for _ in range(rng.randrange(0, 120)))
        least, most = sorted(rng.sample(range(1, 30), 2))
        assert segment.bounded_cuts(text, least, most) == slow_cuts(text, least, most), (text, least, most)


def test_templates_expand_from_the_inside():
    g = extract.Glyphs({"12": "㾮", ("skchar2", "12"): "乙"}, [("s", "AB", "甲")])
    text, seen = extract.expanded("{{header|t=1}}AB{{SKchar|12}}{{SKchar2|12}}{{SKchar|9}}{{?}}{{yl|x|{{pua|y}}}}{{foo|a|k=v|b}}{{雙行註文|新校正云z}}{{*|n}}{{**|base|m}}{{sk note|o}}{{", "s", g, "王某（清）")
    plain = re.sub("⟦[^⟧]*⟧", "", text)
    assert plain == "甲㾮乙〔未识别字9〕〔原文缺字〕xyab新校正云znbasemo{{" and seen["structural"] == 1 and seen["unknown"] == 1
    assert seen["unresolved:skchar"] == 1 and seen["residual"] == 1
    assert "⟦N:新校正:textual_collation⟧" in text and "base⟦N:校注:textual_collation⟧m" in text and "⟦N:王某:commentary⟧o" in text


def test_lines():
    kind = extract.line_kind
    assert [kind(x) for x in ("== 卷一 ==", "<篇名>名", "<目录>目", "::;方", "上古天真論篇第一", "第三千篇", "属性：引", "作者：某", "按：文", "文", "")] == [
        ("2", "卷一"), ("3", "名"), ("2", "目"), ("4", "方"), ("3", "上古天真論篇第一"), ("3", "第三千篇"), ("quote", "引"), ("metadata", ""), ("commentary", ""), ("text", "文"), ("blank", ""),
    ]
    assert kind("篇第一以后又有很多字") == ("text", "篇第一以后又有很多字") and kind("字" * 40 + "篇第一")[0] == "text"
    marked = extract.lines_marked("属性：引文\n续\n按：注\n书名：无\n尾", "s")
    assert marked.split("\n") == ["⟦Q⟧", "引文", "续", "⟦/Q⟧", "按：注", "尾"]
    assert extract.lines_marked("文（注）", "commentary-suwen-zhangzhicong", "张志聪（清）") == "文⟦N:张志聪:commentary⟧（注）⟦/N⟧"


PAGES = "source_id string, page_no int, raw string, title string, layer string, author string"


def test_blocks_carry_headings_across_pages(spark):
    pages = [("s", 1, "== 卷一 ==\n=== 篇一 ===\n前言。黃帝問曰：何也。岐伯曰：善。\n\n{{*|注文}}", "书", "core", "某"), ("s", 2, "续文\n\n==== 小 ====\n文\n\n== 卷二 ==\n文二\n属性：引文\n\n后\n\n== 無 ==\n文三", "书", "core", "某"), ("s", 3, "文四", "书/卷三", "core", "某")]
    got = extract.blocks(spark.createDataFrame(pages, PAGES)).orderBy("page_no", "token_no", "piece_no").collect()
    by = {r.text: r for r in got}
    assert by["黃帝問曰：何也。"].speaker == "黄帝" and by["岐伯曰：善。"].speaker == "岐伯" and by["前言。"].speaker == "原典"
    assert [by[t].speaker_type for t in ("前言。", "岐伯曰：善。", "注文", "引文")] == ["core_text", "dialogue", "textual_collation", "mixed"]
    assert by["注文"].kind == "note" and (by["注文"].volume, by["注文"].section) == ("卷一", "篇一")
    assert (by["续文"].volume, by["续文"].section) == ("卷一", "篇一") and by["文"].subsection == "小"
    assert (by["文二"].volume, by["文二"].section, by["文二"].subsection) == ("卷二", "", "") and by["引文"].kind == "quote" and by["后"].kind == "text"
    assert (by["文三"].volume, by["文三"].section) == ("卷二", "無") and (by["文四"].volume, by["文四"].section) == ("卷三", "無")


def test_pages_become_objects_a_few_at_a_time(spark, monkeypatch):
    pages = [("s", k, f"== 卷{k} ==\ne\n\u0301 文 注{k}。帝曰：\u3000善 a", "", "core", "某") for k in range(3)]
    found = extract.blocks(spark.createDataFrame(pages, PAGES))
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1  # each one more has a worker of its own in every task
    got = [(r.page_no, r.volume, r.text, r.speaker) for r in found.orderBy("page_no", "piece_no").collect()]
    assert got == [row for k in range(3) for row in [(k, f"卷{k}", f"\u00e9 文注{k}。", "原典"), (k, f"卷{k}", "帝曰： 善 a", "黄帝")]]
    seen, kept = [], extract.tokens
    monkeypatch.setattr(extract, "PAGES", 2)
    monkeypatch.setattr(extract, "tokens", lambda text, source: seen.append(text) or kept(text, source))
    made, array = [], extract.pa.array
    monkeypatch.setattr(extract.pa, "array", lambda rows, kind: made.append((len(rows), len(seen))) or array(rows, kind))
    raw = array([*(r[2] for r in pages), None, "尾"])
    out = extract.walked(raw, array(["s"] * 5), array([None, "某", "", "某", "某"]), extract.Glyphs()).to_pylist()
    assert made == [(2, 2), (2, 4), (1, 5)] and [len(x) for x in out] == [2, 2, 2, 0, 1] and out[4][0]["text"] == "尾"
    assert extract.walked(raw.slice(0, 0), raw.slice(0, 0), raw.slice(0, 0), extract.Glyphs()).to_pylist() == []


def test_speakers_of_works(spark):
    rows = [
        ("commentary-jingui-xubin", 1, "本文註曰釋\n論曰說", "t", "commentary", "徐彬（清）"), ("commentary-x", 1, "文", "t", "commentary", "甲（清）"), ("lineage-x", 1, "文", "t", "lineage", "乙"),
        ("commentary-suwen-wangbing", 1, "文{{雙行註文|注}}", "t", "commentary", "王冰"), ("commentary-nanjing-jizhu", 1, "属性：引\n\n=== 序 ===\n属性：序文", "t", "commentary", "丙"),
    ]
    got = {(r.source_id, r.text): (r.speaker, r.speaker_type) for r in extract.blocks(spark.createDataFrame(rows, PAGES)).collect()}
    x = "commentary-jingui-xubin"
    assert got == {
        (x, "本文"): ("张仲景原文", "quoted_core"), (x, "註曰釋"): ("徐彬", "commentary"), (x, "論曰說"): ("徐彬", "commentary"), ("commentary-x", "文"): ("甲", "commentary"), ("lineage-x", "文"): ("乙", "lineage"),
        ("commentary-suwen-wangbing", "文"): ("经文", "quoted_core"), ("commentary-suwen-wangbing", "注"): ("王冰", "commentary"),
        ("commentary-nanjing-jizhu", "引"): ("所引原文", "quoted_core"), ("commentary-nanjing-jizhu", "序文"): ("丙", "preface"),
    }
    stats = {r.source_id: r for r in extract.source_statistics(extract.blocks(spark.createDataFrame(rows, PAGES))).collect()}
    assert stats[x].speaker_types == {"commentary": 2, "quoted_core": 1} and stats[x].blocks == 3 and stats[x].speakers == {"张仲景原文": 1, "徐彬": 2}


def test_transclusions_and_glyph_table(spark):
    raw = '<pages index="a.djvu" from=3 to=5 /> <pages index="b" from=9 to=2 /> <pages index=c from=x to=2>'
    got = extract.transclusions(spark.createDataFrame([(raw,)], "raw string")).collect()
    assert [(r.file, r.scan_number) for r in got if r.error is None] == [("a.djvu", 3), ("a.djvu", 4), ("a.djvu", 5)] and sum(r.error is not None for r in got) == 2
    lines = spark.createDataFrame([('["12"] = { "㾮", "x" },',), ('["13"] = { "", "y" },',), ('["14"] = "",',), ("-- note",)], "line string")
    assert [(r.code, r.value, r.resolution) for r in extract.glyph_table(lines).orderBy("code").collect()] == [("12", "㾮", "primary"), ("13", "y", "fallback"), ("14", "〔未识别字14〕", "placeholder")]
