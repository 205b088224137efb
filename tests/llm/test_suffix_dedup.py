import hashlib
import random
from collections import defaultdict

import pandas as pd
import pytest

from quire.llm import suffix_dedup
from tests.llm.rows import docs, empty, odd


def slow(rows, length, first=False):
    """[(doc_id, n_bytes, n_removed, n_spans, sha)] of rows (doc_id, text)."""
    seen = defaultdict(list)
    body = [(d, (t or "").encode()) for d, t in rows]
    order = sorted(range(len(body)), key=lambda i: body[i][0])
    for i in order:
        b = body[i][1]
        for p in range(len(b) - length + 1):
            seen[hashlib.blake2b(b[p : p + length], digest_size=12).digest()].append((i, p))
    cover = [bytearray(len(b)) for _, b in body]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places[1:] if first else places:
                cover[i][p : p + length] = b"\1" * length
    out = []
    for (d, b), c in zip(body, cover, strict=True):
        left = bytes(x for x, k in zip(b, c, strict=True) if not k)
        runs = sum(1 for i in range(len(c)) if c[i] and not (i and c[i - 1]))
        out.append((d, len(b), len(b) - len(left), runs, hashlib.sha256(left).hexdigest()))
    return out


def result(frame):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in frame.collect())


def test_whole_table_against_brute_force(spark, small):
    found = suffix_dedup.op4_suffix_dedup(spark, small).collect()
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    d = pd.read_parquet(f"{small}/documents.parquet")
    rows = list(zip(d.doc_id, d.text, strict=True))
    assert got == sorted(slow(rows, 400))
    assert any(r[2] for r in got)
    over_50, over_35 = slow_shared(rows, 51), slow_shared(rows, 36)
    shared = {r.doc_id for r in found if r.shared}
    assert over_50 <= shared <= over_35 and over_50


def slow_shared(rows, words):
    """Ids of the rows of which another has so many words in a row."""
    who = defaultdict(set)
    runs = {d: {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} for d, t in rows for w in [(t or "").encode().split()]}
    for d, own in runs.items():
        for x in own:
            who[x].add(d)
    return {d for own in who.values() if len(own) > 1 for d in own}


def test_passages_of_other_documents(spark):
    """A passage of 51 short words is under 400 bytes: it is reported, not removed; a document that repeats itself alone is not."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6)))
    passages = [" ".join(word() for _ in range(51)) for _ in range(20)]
    texts = []
    for p in passages:
        texts += [f"{word()} {p}\n{word()}", f"{p}\t{word()} {word()}"]
    alone = " ".join(word() for _ in range(60))
    texts += [f"{alone} {alone}", " ".join(passages[0].split()[:35]) + f" {word()}", " ".join(word() for _ in range(90)), None, "", "x" * 100_000]
    got = {r.doc_id: r for r in suffix_dedup.substring_dedup(docs(spark, texts)).collect()}
    assert [got[d].shared for d in range(len(texts))] == [True] * 40 + [False] * 6
    assert not any(got[d].n_removed for d in range(len(texts)) if d < 45)


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize(("length", "gram"), [(12, 8), (40, 16), (33, 32)])
def test_random_repeats(spark, length, gram, keep, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "AT_A_TIME", 5)
    rng = random.Random(length)
    words = ["ab", "ba", "é", "aa", " "]
    stock = ["".join(rng.choice(words) for _ in range(rng.randrange(5, 60))) for _ in range(6)]
    texts = ["".join(rng.choice(stock)[rng.randrange(4) : rng.randrange(5, 90)] + "".join(rng.choice(words) for _ in range(rng.randrange(20))) for _ in range(rng.randrange(5))) for _ in range(60)]
    texts += ["a" * 150, "ab" * 90, "\0" * 70, texts[3] + texts[7], texts[3] + texts[7]]
    frame = docs(spark, texts).repartition(3)
    want = sorted(slow(list(enumerate(texts)), length, keep == "first"))
    assert result(suffix_dedup.substring_dedup(frame, length, gram, keep)) == want
    # Every group, or the larger ones, told by hashes of windows.
    for hot_blocks in (0, 2):
        assert result(suffix_dedup.substring_dedup(frame, length, gram, keep, hot_blocks=hot_blocks)) == want


def test_odd_rows(spark):
    got = suffix_dedup.substring_dedup(odd(spark)).collect()
    assert len(got) == 11
    by = {r.doc_id: r for r in got}
    assert by[7].text == " tail" or len(by[7].text) < 20
    assert by[6].text == "" and by[1].n_bytes == 0 and by[8].n_removed == 0
    assert suffix_dedup.substring_dedup(empty(spark)).count() == 0


def test_one_passage_in_most_documents(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(700))
    texts = [f"{i} {rng.random()} {passage} {rng.random()}" for i in range(200)] + [f"{rng.random()}" * 40 for i in range(50)]
    got = suffix_dedup.substring_dedup(docs(spark, texts)).toPandas()
    assert (got[got.doc_id < 200].n_removed >= 700).all() and (got[got.doc_id < 200].n_removed < 720).all()


def test_medium_table_against_brute_force(spark, medium):
    d = pd.read_parquet(f"{medium}/documents.parquet")
    rows = list(zip(d.doc_id, d.text, strict=True))
    found = suffix_dedup.op4_suffix_dedup(spark, medium).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == sorted(slow(rows, 400))
    shared = {r.doc_id for r in found if r.shared}
    assert slow_shared(rows, 51) <= shared <= slow_shared(rows, 36)
