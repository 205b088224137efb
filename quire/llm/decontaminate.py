"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: a shard holds the postings of a run of documents, as rows that are
stored in the folder that all executors share. A shard keeps, term by term, the ascending positions of the
term; documents follow one another with a gap of one position, so a phrase cannot cross from one to the
next. Phrases are found by taking the postings of a phrase's rarest term in the shard, shifted by its offset,
and intersecting them with the shifted postings of the other terms, rarest first. No shard sees another's
postings, so nothing is shuffled, and a term that is in every document costs a shard only its own postings.

Proximity matches take the words of a window in any order within NEAR times its length: occurrences of its rarest
term are kept while every other term, rarest first, stands close enough.

Test items are broadcast in blocks of at most BLOCK_BYTES of text, which are about three times as much in memory (the
items' words as numbers, and where each window begins). A larger benchmark is searched block by block, each block's
hits are stored before the next is sent, and the hits of a row are merged afterwards, told apart by the number of its
shard and its place in it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import stored, table

WINDOW = 13
#: A document is contaminated if PARTS * hit words >= all its words.
PARTS = 20
NEAR = 2
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 8 << 20
#: Occurrences of rarest terms that are followed at a time.
AT_A_TIME = 1 << 20
#: Bytes to words: A-Z become a-z; a-z, 0-9 and all beyond ASCII stay; the rest separates.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

INDEX_SCHEMA = "doc_ids array<long>, n_words array<int>, terms array<string>, counts array<int>, positions binary"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def build_index(docs: DataFrame, vocabulary: set[str] | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The stored index of docs (doc_id, text): one row for each shard, with a number of its own.

    vocabulary: the terms to keep postings of (all if None); it is shipped with the task, so bound it.
    positions: little-endian int32, first differences within each term's run. Null text has no words;
    every row is a document of its own, also if it repeats a doc_id.
    """
    keep = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast({w.encode(): i for i, w in enumerate(sorted(vocabulary), 1)})

    def shard(ids: list, words: list[list[bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(w) for w in words], np.int32)
        flat = [w for ws in words for w in ws]
        known = keep.value if keep is not None else {w: i for i, w in enumerate(dict.fromkeys(flat), 1)}
        code = np.fromiter(map(known.get, flat, repeat(0)), np.int32, len(flat))
        place = np.arange(len(flat)) + np.repeat(np.arange(len(words)), sizes)
        code_at = np.flatnonzero(code)
        order = code_at[np.argsort(code[code_at], kind="stable")]
        used, starts, counts = np.unique(code[order], return_index=True, return_counts=True)
        pos = place[order].astype(np.int32)
        delta = np.diff(pos, prepend=np.int32(0)).astype(np.int32)
        delta[starts] = pos[starts]
        names = {i: w for w, i in known.items()} if keep is None else None
        terms = [(names[i] if names else order_of[i - 1]).decode(errors="replace") for i in used.tolist()]
        values = [pa.array([ids], pa.list_(pa.int64())), pa.array([sizes]), pa.array([terms], pa.list_(pa.string())), pa.array([counts.astype(np.int32)]), pa.array([delta.astype("<i4").tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(values, [x.split()[0] for x in INDEX_SCHEMA.split(", ")])

    order_of: list[bytes] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if keep is not None and not order_of:
            order_of.extend(keep.value)
        ids: list = []
        words: list[list[bytes]] = []
        size = 0
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = t.as_py()
                ids.append(d)
                words.append(words_of(text))
                size += len(text or "")
                if size >= shard_bytes:
                    yield shard(ids, words)
                    ids, words, size = [], [], 0
        if ids:
            yield shard(ids, words)

    shards = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, INDEX_SCHEMA)
    return stored(shards.withColumn("shard", F.monotonically_increasing_id()), "postings")


class Shard:
    """A shard's postings, opened for intersection."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.n_words = np.array(row["n_words"], np.int64)
        self.base = np.concatenate([[0], np.cumsum(self.n_words + 1)])
        self.counts = np.array(row["counts"], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        delta = np.frombuffer(row["positions"], "<i4").astype(np.int64)
        run = np.cumsum(delta)
        start = self.first[:-1]
        self.positions = run - np.repeat(run[start] - delta[start], self.counts) if len(delta) else delta
        self.span = int(self.base[-1]) + 1
        self.keys = np.repeat(np.arange(len(self.counts)), self.counts) * self.span + self.positions
        self.local = {t: i for i, t in enumerate(row["terms"])}

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether each term stands at each place."""
        want = term * self.span + place
        at = np.searchsorted(self.keys, want)
        return (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == want) if len(self.keys) else np.zeros(len(want), bool)

    def candidates(self, p: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(window, places of the rarest term, terms by rarity, their offsets, window lengths), row by row for each occurrence of the
        rarest term of each window whose terms the shard has; at most about AT_A_TIME rows at a time."""
        local = np.fromiter(map(self.local.get, p.terms, repeat(-1)), np.int64, len(p.terms))
        known = np.concatenate([[0], np.cumsum(local[p.words] >= 0)])
        live = np.flatnonzero(known[p.starts + p.lengths] - known[p.starts] == p.lengths)
        if not len(live):
            return
        column = np.arange(p.window)
        least = np.minimum.reduceat(np.where(local[p.words] >= 0, self.counts[local[p.words]], 0), np.column_stack([p.starts[live], p.starts[live] + p.lengths[live] - 1]).ravel())[::2]
        least = np.minimum(least, self.counts[local[p.words[p.starts[live] + p.lengths[live] - 1]]])
        group = np.cumsum(least) // AT_A_TIME
        for part in np.split(live, np.flatnonzero(group[1:] != group[:-1]) + 1):
            inside = column < p.lengths[part][:, None]
            own = local[p.words[np.minimum(p.starts[part][:, None] + column, len(p.words) - 1)]]
            offsets = np.argsort(np.where(inside, self.counts[own], np.iinfo(np.int64).max), axis=1, kind="stable")
            own = np.take_along_axis(own, offsets, 1)
            n = self.counts[own[:, 0]]
            row = np.repeat(np.arange(len(part)), n)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            yield part[row], self.positions[self.first[own[row, 0]] + nth], own[row], offsets[row], p.lengths[part[row]]

    def phrases(self, p: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every occurrence."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for which, place, own, offsets, size in self.candidates(p):
            start = place - offsets[:, 0]
            alive = np.flatnonzero(start >= 0)
            for r in range(1, p.window):
                if not len(alive):
                    break
                off = offsets[alive, r]
                alive = alive[(off >= size[alive]) | self.has(own[alive, r], start[alive] + off)]
            found.append((which[alive], start[alive]))
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

    def nearby(self, p: Phrases, wide: int = NEAR) -> tuple[np.ndarray, np.ndarray]:
        """(window, a place of its rarest term) of spans of at most wide * length words of a document that hold all terms of a window."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for which, place, own, offsets, size in self.candidates(p):
            alive = np.arange(len(which))
            for r in range(1, p.window):
                if not len(alive):
                    break
                reach = size[alive] * wide - 1
                at = np.searchsorted(self.keys, own[alive, r] * self.span + np.maximum(place[alive] - reach, 0))
                ok = self.keys[np.minimum(at, len(self.keys) - 1)] <= own[alive, r] * self.span + place[alive] + reach
                alive = alive[(offsets[alive, r] >= size[alive]) | (ok & (at < len(self.keys)))]
            # Each term is near the rarest one; whether all are in one span is seen for the few that are left.
            alive = alive[[self._in_one_span(own[k, : size[k]], int(place[k]), int(size[k]) * wide) for k in alive.tolist()]] if len(alive) else alive
            found.append((which[alive], place[alive]))
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

    def _in_one_span(self, terms: np.ndarray, place: int, within: int) -> bool:
        d = int(np.searchsorted(self.base, place, side="right")) - 1
        lo, hi = max(int(self.base[d]), place - within + 1), min(int(self.base[d + 1]) - 1, place + within)
        lists = []
        for t in set(terms.tolist()):
            a, b = np.searchsorted(self.keys, [t * self.span + lo, t * self.span + hi])
            lists.append(self.keys[a:b] - t * self.span)
        for left in range(lo, place + 1):
            if all(((x >= left) & (x < left + within)).any() for x in lists):
                return True
        return False

    def documents(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, place, side="right") - 1

    def near(self, words: list[str], within: int) -> list[tuple[int, int]]:
        """(document, first place) of spans of at most within words that hold all words: the earliest span around each rarest word."""
        if not words or any(w not in self.local for w in words):
            return []
        own = sorted({self.local[w] for w in words}, key=lambda t: self.counts[t])
        lists = [self.positions[self.first[t] : self.first[t + 1]] for t in own]
        anchor = lists[0]
        left = np.maximum(anchor[:, None] - within + 1 + np.arange(within), 0)
        ok = np.ones(left.shape, bool)
        for own_places in lists:
            at = np.searchsorted(own_places, left)
            ok &= (at < len(own_places)) & (own_places[np.minimum(at, len(own_places) - 1)] < left + within)
            last = own_places[np.minimum(at, len(own_places) - 1)]
            ok &= self.documents(last) == self.documents(anchor)[:, None]
        hit = ok.any(axis=1)
        doc, start = self.documents(anchor)[hit], left[hit, ok[hit].argmax(axis=1)]
        start = np.maximum(start, self.base[doc])
        return sorted(set(zip(doc.tolist(), (start - self.base[doc]).tolist(), strict=True)))


class Phrases:
    """The windows of a block of test items: the items' words as numbers, where each window begins, and whose it is."""

    def __init__(self, items: Iterable[tuple], window: int = WINDOW):
        number: dict[str, int] = {}
        words, starts, lengths, owner = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        self.items: list[str | None] = []
        at = 0
        for item_id, text in items:
            own = [number.setdefault(w.decode(errors="replace"), len(number)) for w in words_of(text)]
            if own:
                n = max(1, len(own) - window + 1)
                words.append(np.array(own, np.int32))
                starts.append(at + np.arange(n))
                lengths.append(np.full(n, min(len(own), window)))
                owner.append(np.full(n, len(self.items), np.int32))
                self.items.append(None if item_id is None else str(item_id))
                at += len(own)
        self.window, self.terms = window, list(number)
        self.words, self.starts, self.lengths, self.owner = (np.concatenate(x) for x in (words, starts, lengths, owner))


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1] or "")
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


HITS = "shard long, place int, doc_id long, n_words long, spans array<struct<start:int,end:int>>, items array<string>, near array<string>, whole boolean"


def phrase_hits(index: DataFrame, sent, near: bool = True) -> DataFrame:
    """(HITS): for every indexed row its hit word ranges, merged, the items that occur in it, those that occur in it or near (null
    if near is false) and whether a window of full length occurs. sent: a broadcast of Phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                which, start = shard.phrases(p)
                edge = np.zeros(shard.span + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + p.lengths[which], -1)
                hit = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8), [0]])
                lo, hi = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
                n = len(shard.doc_ids)
                spans: list[list] = [[] for _ in range(n)]
                for d, a, b in zip(shard.documents(lo).tolist(), lo.tolist(), hi.tolist(), strict=True):
                    spans[d].append({"start": a - int(shard.base[d]), "end": b - int(shard.base[d])})

                def named(which: np.ndarray, place: np.ndarray, shard: Shard = shard, n: int = n) -> list[set]:
                    own: list[set] = [set() for _ in range(n)]
                    for d, k in set(zip(shard.documents(place).tolist(), p.owner[which].tolist(), strict=True)):
                        if p.items[k] is not None:
                            own[d].add(p.items[k])
                    return own

                items = named(which, start)
                close = [sorted(x | y) for x, y in zip(named(*shard.nearby(p)), items, strict=True)] if near else [None] * n
                whole = np.zeros(n, bool)
                whole[shard.documents(start[p.lengths[which] == p.window])] = True
                cols = [[row["shard"]] * n, range(n), shard.doc_ids, shard.n_words, spans, [sorted(x) for x in items], close, whole]
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [x.split()[0] for x in HITS.split(", ")])

    return index.mapInArrow(run, HITS)


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, parts: int = PARTS, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, index: DataFrame | None = None, near: bool = True
) -> DataFrame:
    """(doc_id, n_words, spans, items, near, whole, n_hit, contaminated), one row for each row of docs.

    items: (item_id, text). spans are the maximal word ranges that lie in occurrences of an item's windows
    (window consecutive words; a shorter item is one window). near: the items of which a window's words stand, in any
    order, within NEAR times its length (exact occurrences are among them); null if near is false. whole: whether a window
    of full length occurs. Items without words never occur; a null item_id marks words but is not listed. Null text has no
    words and is not contaminated. Rows that repeat a doc_id, or have none, are documents of their own. Empty tables give
    no rows or no hits. index: a stored index of docs, with all terms or those of items; it is built if there is none.
    """
    spark = docs.sparkSession
    blocks = _blocks(items.select("item_id", "text"), block_bytes)
    block, following = next(blocks, []), next(blocks, None)
    found: list[DataFrame] = []
    while block is not None:
        phrases = Phrases(block, window)
        if index is None:
            index = build_index(docs, set(phrases.terms) if following is None else None, shard_bytes)
        sent = spark.sparkContext.broadcast(phrases)
        hits = phrase_hits(index, sent, near)
        if following is not None or found:
            hits = stored(hits if not found else hits.where("size(spans) > 0 or size(near) > 0"), "benchmark-hits")
            sent.unpersist()
        found.append(hits)
        block, following = following, next(blocks, None) if following is not None else None
    out = found[0]
    if len(found) > 1:
        for more in found[1:]:
            out = out.unionByName(more)
        every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        out = out.groupBy("shard", "place").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), every("spans"), every("items"), every("near"), F.bool_or("whole").alias("whole"))
        out = out.withColumn(
            "spans",
            F.expr(
                """aggregate(spans, cast(array() as array<struct<start:int,end:int>>), (acc, x) ->
                   if(size(acc) > 0 and element_at(acc, -1).end >= x.start,
                      concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).start as start, greatest(element_at(acc, -1).end, x.end) as end))),
                      concat(acc, array(x))))"""
            ),
        )
        if not near:
            out = out.withColumn("near", F.lit(None).cast("array<string>"))
    n_hit = F.expr("aggregate(spans, 0L, (acc, x) -> acc + x.end - x.start)")
    return out.drop("shard", "place").withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * parts >= F.col("n_words")))


def near_words(index: DataFrame, words: list[str], within: int) -> DataFrame:
    """(doc_id, start): spans of at most within words in which all words stand; start is a word number of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                found = shard.near(words, within)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([shard.doc_ids[d] for d, _ in found], pa.int64()), pa.array([s for _, s in found], pa.int64())], ["doc_id", "start"])

    return index.mapInArrow(run, "doc_id long, start long")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=False)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without the documents in which a window of full length occurs, or that are contaminated by shorter items.

    A passage of an item may be a small part of a long document and yet teach the answer, so the share of hit words only
    decides about items that are shorter than a window. All columns stay; every row is judged by its own text, also if it
    repeats a doc_id or has none; null and empty texts stay; with no items, all rows do.
    """
    own = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = decontaminate(docs.select(own.alias("doc_id"), "text"), items, near=False)
    bad = found.where("whole or contaminated").select(F.col("doc_id").alias("__quire_bad")).distinct()
    return docs.join(bad, own == F.col("__quire_bad"), "left_anti")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS phrase FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS phrase FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
h AS (SELECT doc_id, s, n, item_id FROM p JOIN i USING (n, phrase)),
k AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS x FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN m USING (doc_id)
"""
