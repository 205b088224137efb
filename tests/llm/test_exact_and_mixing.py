import hashlib
import re
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.llm import exact_dedup, mixing
from tests.llm.rows import docs, empty, odd


def test_exact_dedup_against_brute_force(spark, medium):
    got = exact_dedup.op7_exact_dedup(spark, medium).toPandas().set_index("doc_id")
    d = pd.read_parquet(f"{medium}/documents.parquet")
    by = d.groupby("text").doc_id
    want = pd.DataFrame({"keep_id": by.transform("max").values, "group_size": by.transform("size").values}, index=d.doc_id).loc[got.index]
    assert (got.keep_id == want.keep_id).all() and (got.group_size == want.group_size).all()
    assert (got.kept == (got.keep_id == got.index)).all()
    sha = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in zip(d.doc_id, d.text, strict=True)}
    assert all(sha[i] == x for i, x in got.text_sha256.items())


@pytest.mark.parametrize(("prefix", "bits"), [(512, 1 << 24), (1, 64), (512, 64)])
def test_exact_dedup_odd_rows(spark, prefix, bits):
    got = {(r.doc_id, r.group_size, r.keep_id, r.kept) for r in exact_dedup.exact_dedup(odd(spark), prefix=prefix, bits=bits).collect()}
    assert got >= {(1, 3, 2, False), (2, 3, 2, True), (None, 3, 2, False), (3, 1, 3, True), (4, 3, 4, True), (None, 3, 4, False), (6, 1, 6, True), (7, 1, 7, True)}
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out, free = share * sum(sizes.values()), {}, set(names)
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total >= cap * sizes[s]}
        if not over:
            return out | {s: left * w[s] / total for s in free}
        out |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free -= over
    return out


def test_mixing_against_brute_force(spark, medium):
    got = mixing.op8_mixing(spark, medium).toPandas()
    again = mixing.op8_mixing(spark, medium).toPandas()
    assert got.set_index("doc_id").taken.sort_index().equals(again.set_index("doc_id").taken.sort_index())
    d = pd.read_parquet(f"{medium}/documents.parquet")
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in zip(d.doc_id, d.text, strict=True)}
    source, total = dict(zip(d.doc_id, d.source, strict=True)), defaultdict(int)
    for i, s in source.items():
        total[s] += size[i]
    want = slow_targets(total)
    for r in got.itertuples():
        assert r.size == size[r.doc_id] and r.source_size == total[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]], rel=1e-9) and 0 <= r.taken <= 2 * r.size
    for s, g in got.groupby(got.doc_id.map(source)):
        assert abs(g.taken.sum() - want[s]) <= 1
    assert len(got) == len(d)


def test_targets_equal_their_sql(spark, medium):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{medium}/documents.parquet'")
    want = {r[1]: r[2:] for r in con.sql(mixing.OP8_SQL).fetchall()}
    sizes = spark.read.parquet(f"{medium}/documents.parquet").select("source", mixing.n_words(F.col("text")).alias("size"))
    got = {r.source: (r.source_size, round(r.target, 3)) for r in mixing.targets(sizes).collect()}
    assert got == {k: (n, round(t, 3)) for k, (n, t) in want.items()}


def test_mixing_odd_rows(spark):
    got = mixing.mix(odd(spark), buckets=4)
    rows = got.collect()
    assert len(rows) == 11 and {r.mix_size for r in rows} == {0, 1, 4, 6, 30_000, 30_001}
    want = slow_targets({"a": 3, "b": 60_001, None: 10})
    for s in ("a", "b", None):
        assert abs(sum(r.mix_taken for r in rows if r.source == s) - want[s]) <= 1
    out = mixing.repeated(got)
    assert out.columns == odd(spark).columns
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in out.collect()) == sum(r.mix_taken for r in rows)
    assert mixing.mixed_documents(odd(spark)).columns == odd(spark).columns and mixing.mixed_documents(empty(spark)).count() == 0
    assert mixing.mix(empty(spark)).count() == 0 and mixing.repeated(mixing.mix(empty(spark))).count() == 0
    assert mixing.mix(docs(spark, [None, ""])).select("mix_taken").distinct().collect()[0][0] == 0


def test_columns_of_the_mix_s_own_names(spark):
    """A column mix_size of the input isn't taken for word counts, and user columns that begin with mix_ stay."""
    given = docs(spark, ["one two three", "four five"]).withColumns({"mix_size": F.lit(99), "mix_mine": F.lit("m"), "mix_taken": F.lit("t"), "words": F.lit(5)})
    got = mixing.mix(given)
    assert {(r.doc_id, r.mix_size, r.mix_mine) for r in got.collect()} == {(0, 3, "m"), (1, 2, "m")}
    assert "mix_mine" in mixing.repeated(got).columns
    out = mixing.mixed_documents(given)
    assert out.columns == given.columns and {(r.mix_size, r.mix_mine, r.mix_taken) for r in out.collect()} == {(99, "m", "t")}
