import random

import numpy as np
import pandas as pd
import xxhash

from quire.llm import simhash
from tests.llm.rows import docs, empty, odd


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps, budget=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= budget) + i + 1:
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(fps))]


def test_whole_table_against_brute_force(spark, medium):
    got = simhash.op5_simhash(spark, medium).toPandas().sort_values("doc_id")
    docs_ = pd.read_parquet(f"{medium}/documents.parquet").sort_values("doc_id")
    fps = [slow_fingerprint(t) for t in docs_.text]
    assert got.fingerprint.tolist() == [f"{x:016x}" for x in fps]
    assert got.component_id.tolist() == slow_components(docs_.doc_id.tolist(), fps)


def test_trie_join_on_dense_and_chunked_groups(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set()
    for b in base:
        for _ in range(60):
            x = b
            for _ in range(rng.randrange(7)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = slow_components(list(range(len(fps))), fps)
    for chunk in (20_000, 13):
        links = simhash.hamming_links(df, chunk=chunk).toPandas()
        at = {x: i for i, x in enumerate(signed)}
        labels = simhash._settle(np.arange(len(fps)), links.a.map(at).to_numpy(), links.b.map(at).to_numpy())
        assert labels.tolist() == want


def test_odd_rows(spark):
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.simhash_groups(odd(spark)).collect()}
    assert got[(2, 0)] == 1 and got[(3, 0)] == 1 and got[(None, 0)] == 1
    assert len({v for (d, f), v in got.items() if d in (6, 7)}) == 1
    assert simhash.simhash_groups(odd(spark)).count() == 11
    assert simhash.simhash_groups(empty(spark)).count() == 0
    kept = simhash.keep_first(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 1, 4, 4, 5, 6, 8]


def test_one_key_holds_most_rows(spark):
    texts = ["same text of many copies here"] * 300 + [f"other words {i} and {i * 7} with {i * 13}" for i in range(100)]
    got = simhash.simhash_groups(docs(spark, texts)).toPandas()
    assert (got[got.doc_id < 300].component_id == 0).all()
