import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import decontaminate, token_store
from tests.llm.rows import docs, empty, odd


def slow_tokens(frame):
    tok, start, out = Tokenizer.from_file(token_store.default_tokenizer()), 0, []
    for r in frame.sort_values("doc_id").itertuples():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
        out.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_tokens_against_brute_force(spark, medium):
    got = token_store.op3_tokens(spark, medium).toPandas().sort_values("doc_id")
    want = slow_tokens(pd.read_parquet(f"{medium}/documents.parquet"))
    assert list(got.itertuples(index=False, name=None)) == want


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 100, 1001])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32 if n % 2 else 300, n, dtype=np.uint32)
    index, payload = token_store.pack(ids, 100, kind)
    assert (token_store.unpack(index, payload, n, 100, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_tokens_odd_rows(spark, kind):
    odd_texts = ["a<|endoftext|>b", "it's  'll x y", "é ́", "İΣς ΑΣ", "\x1c\x85z", "don't-stop 12,34"]
    for frame in (odd(spark), docs(spark, odd_texts)):
        chunks = token_store.write_tokens(frame, kind=kind, chunk_ids=50, block=16, partitions=3)
        got = sorted(token_store.read_tokens(chunks).collect(), key=lambda r: r.start)
        tok, start = Tokenizer.from_file(token_store.default_tokenizer()), 0
        rows = sorted(frame.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
        for r, g in zip(rows, got, strict=True):
            ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
            assert (g.doc_id, g.start, g.ids) == (r.doc_id, start, ids)
            start += len(ids)
    assert token_store.read_tokens(token_store.write_tokens(empty(spark))).count() == 0


def low_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def slow_contamination(texts, items, window=13):
    grams = {}
    for i, t in items:
        w = low_words(t)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[a : a + window]), set()).add(str(i))
    sizes = sorted({len(g) for g in grams})
    out = []
    for d, t in texts:
        w, hit, own = low_words(t), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if (g := tuple(w[a : a + n])) in grams:
                    hit.update(range(a, a + n))
                    own |= grams[g]
        names = ",".join(sorted(own))
        out.append((d, len(w), len(hit), len(own), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_decontamination_against_brute_force(spark, medium):
    got = decontaminate.op1_decontamination(spark, medium).toPandas().sort_values("doc_id")
    d, b = pd.read_parquet(f"{medium}/documents.parquet"), pd.read_parquet(f"{medium}/benchmark.parquet")
    want = slow_contamination(zip(d.doc_id, d.text, strict=True), list(zip(b.item_id, b.text, strict=True)))
    assert list(got.itertuples(index=False, name=None)) == sorted(want)
    assert got.contaminated.any()


ITEMS = [(1, "alpha beta gamma"), (2, None), (3, " .. "), (4, "ALPHA beta"), (None, "delta"), (10, " ".join(f"w{i}" for i in range(20))), (10, "Beta gamma")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 10])
def test_decontamination_cases(spark, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    texts = ["x alpha,Beta gamma alpha beta", "alpha gamma", None, "", " ".join(f"w{i}" for i in range(3, 18)), "beta", "gamma delta", "ends with alpha", "beta starts", "alpha alpha beta beta gamma é"]
    got = decontaminate.decontaminate(docs(spark, texts), items, block_bytes=block_bytes, shard_bytes=20).collect()
    want = slow_contamination(enumerate(texts), [x for x in ITEMS if x[0] is not None])
    want = {w[0]: w[1:] for w in want}
    for r in got:
        names = hashlib.sha256(",".join(r["items"]).encode()).hexdigest()
        if r.doc_id != 6:
            assert (r.n_words, r.n_hit, len(r["items"]), names, r.contaminated) == want[r.doc_id], r
        else:
            assert (r.n_hit, r["items"], r.contaminated) == (1, [], True)
    assert len(got) == len(texts)


def test_rows_of_one_id_stay_apart_in_several_blocks(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    texts = [(1, "alpha beta gamma"), (1, "far " * 200 + "alpha beta"), (1, None), (None, "gamma delta"), (None, "x"), (None, None), (2, "beta gamma"), (2, "beta gamma")]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    of = lambda block_bytes: sorted(map(str, decontaminate.decontaminate(frame, items, block_bytes=block_bytes, shard_bytes=20).collect()))
    assert len(of(10)) == len(texts) and of(10) == of(1 << 20)


def test_decontamination_odd_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.decontaminate(odd(spark), items).count() == 11
    assert decontaminate.decontaminate(empty(spark), items).count() == 0
    none = decontaminate.decontaminate(odd(spark), items.limit(0)).collect()
    assert len(none) == 11 and not any(r.n_hit for r in none)
    out = decontaminate.without_contaminated(odd(spark), spark.createDataFrame([(1, "two three four")], "item_id long, text string"))
    assert out.columns == odd(spark).columns and sorted(r.doc_id or -1 for r in out.collect()) == [-1, -1, 1, 2, 3, 4, 4, 6, 7, 8]


def test_near_words(spark):
    texts = ["red x x blue", "blue red", "red x x x x blue", "red", "red. blue red x blue"]
    index = decontaminate.build_index(docs(spark, texts), shard_bytes=12)
    got = {(r.doc_id, r.start) for r in decontaminate.near_words(index, ["red", "blue"], 4).collect()}
    assert {d for d, _ in got} == {0, 1, 4}
    assert (0, 0) in got and (1, 0) in got


def slow_near(texts, items, window, wide):
    """{number of the text: items of which all words of a window stand in some span of wide * its length words}."""
    out = {}
    for d, t in enumerate(texts):
        w, own = low_words(t), set()
        for i, x in items:
            iw = low_words(x)
            for a in range(max(1, len(iw) - window + 1) if iw else 0):
                part = iw[a : a + window]
                if any(set(part) <= set(w[k : k + wide * len(part)]) for k in range(len(w))):
                    own.add(str(i))
        out[d] = sorted(own)
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_near_items_against_brute_force(spark, block_bytes):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 60))) for _ in range(60)] + [None]
    given = [(i, " ".join(rng.choice("abcdefghz") for _ in range(rng.randrange(0, 8)))) for i in range(20)]
    items = spark.createDataFrame(given, "item_id long, text string")
    got = decontaminate.decontaminate(docs(spark, texts), items, window=5, block_bytes=block_bytes, shard_bytes=100).collect()
    assert {r.doc_id: r.near for r in got} == slow_near(texts, given, 5, decontaminate.NEAR)
    assert all(set(r["items"]) <= set(r.near) for r in got)


def test_a_passage_in_a_long_document_is_dropped(spark):
    """13 words of an item are far under a twentieth of the document: op1 doesn't call it contaminated, the filter drops it."""
    passage = " ".join(f"secret{i}" for i in range(13))
    items = spark.createDataFrame([(1, f"{passage} and more"), (2, "tiny item")], "item_id long, text string")
    filler = " ".join(f"w{i}" for i in range(2000))
    texts = [f"{filler} {passage} {filler}", filler, f"{filler} tiny item", "a tiny item", None, "", f"{filler} {' '.join(passage.split()[:12])}"]
    frame = docs(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") < 2, F.lit(7)).otherwise(F.col("doc_id")))  # two rows of one id
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs(spark, texts), items).collect()}
    assert [got[d].whole for d in range(7)] == [True] + [False] * 6 and [got[d].contaminated for d in range(7)] == [False, False, False, True, False, False, False]
    kept = decontaminate.without_contaminated(frame, items)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted((7 if d < 2 else d, texts[d] or "") for d in (1, 2, 4, 5, 6))


def test_other_tokenizers_encode_whole_texts():
    """Ids depend on white space there, so pieces must not be encoded apart; the default one is told from its file."""
    import public_tokenizers

    texts = ["a  b\n c", "", None, "Hello world's <|endoftext|> ½", "x" * 500 + " yes"]
    for name, apart in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)):
        path = public_tokenizers.path(name)
        encode, tok = token_store.Encoder(path), Tokenizer.from_file(path)
        assert encode.apart == token_store.encodes_apart(path) == apart
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_long_pieces_are_not_remembered():
    encode = token_store.Encoder(token_store.default_tokenizer())
    tok = Tokenizer.from_file(token_store.default_tokenizer())
    texts = ["Q" * 100_000, "漢字" * 3000, "aGVsbG8+" * 900 + " short", "short " + "z" * 65, "z" * 64]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(map(len, encode.known)) <= token_store.LONGEST and max(map(len, encode.plain)) <= token_store.LONGEST
