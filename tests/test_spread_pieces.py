"""What the queries on pieces hold and over how many tasks they go."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from quire.operators import segment


def test_cuts_alone_hold_no_texts(spark):
    frame = spark.createDataFrame([(None,), ("",), ("甲HT。" * 300,), ("x" * 1500,)], "t string")
    whole, cuts = segment.pieces(F.col("t")), segment.pieces(F.col("t"), with_text=False)
    for a, b, t in frame.select(whole, cuts, "t").collect():
        assert [(p.start, p.end, p.issues) for p in a] == [(p.start, p.end, p.issues) for p in b]
        assert "".join(p.text for p in a) == (t or "") and all("text" not in p for p in b)


def test_rows_that_make_much_work_go_to_all_cores(spark, small):
    for name in ("bounded_pieces", "semantic_pieces"):
        plan = entry.queries()[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition" in plan
