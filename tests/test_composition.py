"""Unicode composition in the JVM against Python's."""

import unicodedata

from pyspark.sql import functions as F

from quire.functions import text as X


def test_composition_equals_that_of_python_and_needs_none(spark):
    assigned = [c for c in map(chr, range(0x20, 0x30000)) if unicodedata.category(c) not in ("Cn", "Cs", "Co")]
    texts = [None, "", "ﬁ Å é 한글 ｶﾞ ①", "ẹ́ å q̣̇", "한", *("a" + "".join(assigned[k : k + 500]) for k in range(0, len(assigned), 500))]
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string")
    out = frame.select("k", X.nfkc(F.col("x")).alias("c"), X.nfc(F.col("x")).alias("d"), X.normalize_corpus(F.col("x")).alias("n"))
    assert "EvalPython" not in out._jdf.queryExecution().executedPlan().toString()
    form = lambda f, x: None if x is None else unicodedata.normalize(f, x)
    assert {r.k: (r.c, r.d) for r in out.collect()} == {k: (form("NFKC", x), form("NFC", x)) for k, x in enumerate(texts)}
