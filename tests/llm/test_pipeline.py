import re
import zlib

import numpy as np
import pandas as pd
from tokenizers import Tokenizer

import corpus_pipeline
from quire.llm import token_store, toxicity
from tests.llm.rows import empty, odd
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.llm.test_tokens_and_decontamination import low_words, slow_contamination


def kept_by_plain_python(spark, sf_dir):
    d = pd.read_parquet(f"{sf_dir}/documents.parquet").sort_values("doc_id")
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    scorer = toxicity.fit(toxicity.training_rows(read("documents"), read("labels"))).open()
    d = d[[scorer.score(t) < 0.3 for t in d.text]]
    fps = [slow_fingerprint(t) for t in d.text]
    d = d[np.array(slow_components(d.doc_id.tolist(), fps)) == d.doc_id.to_numpy()]
    b = pd.read_parquet(f"{sf_dir}/benchmark.parquet")
    bad = {r[0] for r in slow_contamination(zip(d.doc_id, d.text, strict=True), list(zip(b.item_id, b.text, strict=True))) if r[5]}
    windows = lambda t: {tuple(w[k : k + 13]) for w in [low_words(t)] for k in range(len(w) - 12)}
    asked = set().union(*map(windows, b.text))
    return d[[i not in bad and not windows(t) & asked for i, t in zip(d.doc_id, d.text, strict=True)]]


def test_run_against_plain_python(spark, small):
    got = corpus_pipeline.run(spark, small).toPandas().sort_values("start")
    want = kept_by_plain_python(spark, small)
    assert 0 < len(want) < 200 and set(got.doc_id) <= set(want.doc_id)
    assert (got.start.to_numpy() == np.concatenate([[0], np.cumsum(got.n_tokens)[:-1]])).all() and got.doc_id.is_monotonic_increasing
    tok = Tokenizer.from_file(token_store.default_tokenizer())
    crc = {i: zlib.crc32(np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in zip(want.doc_id, want.text, strict=True)}
    whole = got[[crc[i] == c for i, c in zip(got.doc_id, got.ids_crc32, strict=True)]]
    assert len(got) - len(whole) <= want.source.nunique()  # at most one part of a document for each source
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in zip(want.doc_id, want.text, strict=True)}
    taken = whole.doc_id.map(size).sum()
    assert 1.3 * sum(size.values()) < taken <= 1.5 * sum(size.values()) + 1
    assert (whole.doc_id.value_counts() <= 2).all()


def test_stages_take_odd_rows(spark, small):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "mixing", "token ids"]
    for make in (odd, empty):
        frame = make(spark)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, small)
            assert out.columns == frame.columns
        assert corpus_pipeline.STAGES[-1][1](spark, frame, small).count() == frame.count()
