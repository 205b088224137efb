from pyspark.sql import functions as F

from quire.functions.text import CJK_KEEP
from quire.operators import index
from quire.streaming import incremental
from tests.test_retrieval import DOCS, slow_bm25


def test_stream_index_equals_batch(spark, tmp_path):
    schema = "id string, title string, text string"
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for part in (DOCS[:2], DOCS[2:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        incremental.index_stream(stream, out, check, keep=CJK_KEEP).awaitTermination()
    stored, wanted = incremental.StreamedIndex(spark, out), index.groups(spark, [(0, "治未病")])
    got = {r.id: round(r["rank"], 9) for r in index.bm25(stored.hits(index.grams_of(["治未病"])), stored.totals, wanted).collect()}
    assert got == {d: round(x, 9) for d, x in slow_bm25(["治未病"]).items()}
    assert stored.lengths.agg(F.count("*")).first()[0] == len(DOCS)
