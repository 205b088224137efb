"""Text operators on literal rows."""

import hashlib
import urllib.parse

from pyspark.sql import functions as F

from quire.functions import text as X


def one(spark, text, *columns):
    return spark.createDataFrame([(text,)], "text string").select(*columns).first()


def test_normalizers_differ_as_they_should(spark):
    t = F.col("text")
    r = one(spark, "黃帝內經 鬬 五藏·Abc-1 é", X.normalize_query(t), X.normalize_index(t), X.normalize_evidence(t), X.normalize_query(t, X.LETTER_KEEP))
    assert r[0] == "黄帝内经斗五脏abc1" and r[1] == "黄帝内经鬬五脏abc1" and r[2] == "黄帝内经鬬五藏abc1" and r[3].endswith("abc1é")
    assert one(spark, "針灸 療效", X.normalize_alias(t))[0] == "针灸疗效"


def test_corpus_normalizer(spark):
    got = one(spark, "Ａｂ〔未识别字12〕治未病！", X.normalize_corpus(F.col("text"), drop=("〔未识别字[0-9]+〕",), replacements=(("病", "疾"),)))[0]
    assert got == "ab治未疾"


def test_bigrams(spark):
    t = F.col("text")
    for text, want in (("治未病", ["治未", "未病"]), ("治", ["治"]), ("", []), ("aaa", ["aa", "aa"]), ("𠀀𠀁x", ["𠀀𠀁", "𠀁x"]), ("a\nb", ["a\n", "\nb"])):
        r = one(spark, text, X.bigrams(t), X.bigram_set(t))
        assert r[0] == want and r[1] == list(dict.fromkeys(want))
    assert one(spark, None, X.bigrams(t))[0] in (None, [])


def test_jaccard(spark):
    a = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    r = spark.range(1).select(X.jaccard(a("x", "y"), a("y", "z")), X.jaccard(a(), a("x")), X.jaccard(a("x"), a("x"))).first()
    assert abs(r[0] - 1 / 3) < 1e-12 and r[1] == 0 and r[2] == 1


def test_url_quote_is_percent_encoding(spark):
    for s in ("黃帝內經/卷一 *~", "a+b&c=d", "x_-.y"):
        assert one(spark, s, X.url_quote(F.col("text")))[0] == urllib.parse.quote(s, safe="")


def test_strip_wiki(spark):
    raw = "<!-- c -->'''bold''' [[File:x.png|thumb]] [[target|label]] [[plain]] [http://u v w] [http://u]<ref>r</ref><ref name=a/>\n* item\n{| t\n| cell\n<br/>-{zh:甲-}&amp;&eacute;"
    got = one(spark, raw, X.strip_wiki(F.col("text")))[0]
    assert got.split() == ["bold", "label", "plain", "v", "w", "item", "{|", "t", "甲&é"]


def test_clean_plain(spark):
    assert one(spark, "甲　乙 \n 丙  ， a  b ", X.clean_plain(F.col("text")))[0] == "甲乙丙， a b"


def test_chinese_numbers_and_page_order(spark):
    for s, n in (("十", 10), ("十二", 12), ("二十", 20), ("一百零三", 103), ("一〇三", 103), ("42", 42), ("三千二百", 3200)):
        assert one(spark, s, X.chinese_number(F.col("text")))[0] == n
    titles = ["书/卷十", "书/卷二下", "书/卷二上", "书/卷首", "书/序", "书/原病篇", "书/第三卷", "书/x"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in titles], "t string").orderBy(X.page_key(F.col("t"))).collect()]
    assert got == ["书/序", "书/原病篇", "书/卷首", "书/卷二上", "书/卷二下", "书/第三卷", "书/卷十", "书/x"]


def test_title_score(spark):
    rows = [("傷寒論", "伤寒论", 100.0), ("傷寒論", "伤寒论浅注", 90.0), ("傷寒論", "黄帝伤寒论", 78.0), ("黄帝伤寒论", "伤寒论", 70.0), ("傷寒論", "傷寒論/卷一", 78.0), ("伤寒论", "伤寒论序", 70.0), ("", "x", 0.0), ("ab", "bc", 20.0)]
    for q, t, want in rows:
        assert spark.createDataFrame([(q, t)], "q string, t string").select(X.title_score(F.col("q"), F.col("t"))).first()[0] == want, (q, t)


def test_ordered_hashes(spark):
    df = spark.createDataFrame([(2, "k", "b"), (1, "k", "a"), (3, "z", None), (1, None, "x")], "n int, g string, v string")
    got = {r.g: (r.n, r.digest) for r in X.ordered_hashes(df, "g", ["n"], "v").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert got == {"k": (2, sha(b"a\nb\n")), "z": (1, sha(b"\n")), None: (1, sha(b"x\n"))}
    assert X.ordered_hashes(df.limit(0), "g", ["n"], "v").count() == 0


def test_issues_and_fragments(spark):
    t = F.col("text")
    assert one(spark, "〔未识别字3〕HT x KTx ", X.issue_counts(t))[0] == {"explicit-missing-glyph": 1, "legacy-glyph-placeholder-ht-kt": 1, "private-use-character": 1}
    for s, want in (("短", "too-short"), ("三四五六七八九十百", "quantity-only"), ("见上一二三四五六七", "reference-only"), ("夫百病之始生也皆生于风雨", None)):
        assert one(spark, s, X.fragment_reason(t))[0] == want
    assert one(spark, "甲乙", X.char_differences(t, F.lit("甲丙丁")))[0] == 2
