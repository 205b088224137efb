"""Repeated substrings by a sparse, distributed suffix array and its longest-previous-factor test.

A corpus-wide suffix array would need every suffix in one order. Only suffixes that can share LENGTH bytes
with another matter, and those agree on their anchor: the least GRAM-byte hash within the string's LENGTH
bytes (leftmost on ties), which depends on the string alone. So

1. each document is cut into runs of starts with the same anchor (winnowing, one anchor in about
   (LENGTH - GRAM) / 2 bytes), and anchors whose hash occurs once are dropped after a pre-aggregated count;
2. what is left goes, as a block of the bytes that its starts can reach, to the group of its anchor hash.
   Equal blocks are counted before they meet, so that a passage copied into a third of all rows is one row;
3. in a group the suffixes of all blocks are put in order column by column from the right: the order at
   one column, sorted stably by the byte before it, is the order at the column before. The column
   at which neighbours in suffix order first differ is carried along, which is their longest common prefix;
4. a start has a match of LENGTH bytes if its longest common prefix with a neighbour in suffix order is as
   long. For longest-previous-factor semantics (keep="first") the nearest smaller positions before and
   after it in suffix order are asked for: one of them matches LENGTH bytes exactly if the least
   position of the run of suffixes that share LENGTH bytes is smaller than its own;
5. an anchor with more than HOT distinct blocks, such as one in a passage that a third of all documents quote, is no group for one
   task. Its starts are told by 128-bit hashes of their LENGTH bytes instead, counted with map-side aggregation.

Beside that it is told which documents share a passage of over PASSAGE words, as such a passage may be shorter than
LENGTH bytes. Each run of PASSAGE + 1 words has an anchor of WORD_GRAM words, the least by hash, and two documents that
share the run share its anchor; so every such passage is seen, and nothing under WORD_GRAM words is.

Comparison is on bytes; hashes bring candidates together. A verdict goes back to the copies of a block by 128 bits of
hash (its anchor's and its own) with its extent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import checkpointed, stored, table, whole_groups

LENGTH = 400
GRAM = 128
PASSAGE = 50
WORD_GRAM = 36
#: Never a byte of UTF-8: stands where a block has no byte.
NONE = 0xFF
#: Distinct blocks that are ordered at a time (groups are never cut).
AT_A_TIME = 16_000
#: Anchors of more distinct blocks than this are not ordered in one task.
HOT = 2_000
#: Up to so many hot anchors (8 bytes each) are broadcast.
MOST_BROADCAST = 1_000_000
#: Bytes whose anchors are found at a time; more leave the processor's cache.
PIECE = 1 << 17

MUL = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(buf: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the gram bytes from each place of buf; gram is a power of two from 8 on."""
    n = len(buf) - 7
    h = np.empty(max(n, 0), np.uint64)
    raw = buf.tobytes()
    for o in range(min(8, max(n, 0))):
        part = np.frombuffer(raw, "<u8", (len(raw) - o) // 8, o)
        h[o::8] = part[: len(h[o::8])]
    h *= MUL
    h ^= h >> np.uint64(29)
    size = 8
    while size < gram:
        h = h[:-size] * MUL + h[size:]
        h ^= h >> np.uint64(31)
        size *= 2
    return h * MUL


def anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, anchor, first start, last start) for every run of starts with one anchor; places within the text."""
    size = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    buf = np.frombuffer(b"".join(texts), np.uint8)
    grams = length - gram + 1
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return none, none, none, none, none
    h = gram_hashes(buf, gram)
    least, reach = h, 1
    while reach * 2 <= grams:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if grams > reach:
        least = np.minimum(least[: len(least) - (grams - reach)], least[grams - reach :])
    n = len(buf) - length + 1
    least = least[:n]
    valid = np.zeros(n + 1, np.int8)
    for a, b in zip((end - size).tolist(), end.tolist(), strict=True):
        if b - a >= length:
            valid[a : b - length + 1] = 1
    valid = valid[:n]
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
    s = np.flatnonzero(new)
    e = np.append(s[1:], n) - 1
    s, e = s[valid[s] == 1], e[valid[s] == 1]
    at = np.empty(len(s), np.int64)
    span = np.arange(grams)
    for k in range(0, len(s), 4096):
        part = s[k : k + 4096]
        at[k : k + 4096] = part + (h[part[:, None] + span] == least[part][:, None]).argmax(axis=1)
    tied = np.flatnonzero(e > at)
    if len(tied):
        more = []
        for k in tied.tolist():
            places = s[k] + np.flatnonzero(h[s[k] : e[k] + grams] == least[s[k]])
            lo = np.concatenate([[s[k]], places[:-1] + 1])
            hi = np.minimum(places, e[k])
            ok = lo <= hi
            more.append(np.stack([places[ok], lo[ok], hi[ok]]))
        rest = np.setdiff1d(np.arange(len(s)), tied)
        joined = np.concatenate([np.stack([at[rest], s[rest], e[rest]]), *more], axis=1)
        at, s, e = joined
    which = np.searchsorted(end, s, side="right")
    base = (end - size)[which]
    return which, h[at].view(np.int64), at - base, s - base, e - base


SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _window_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of values[lo:hi] for each range: differences of prefix sums of a polynomial, shifted to their start."""
    factor = np.uint64(base)
    powers = np.multiply.accumulate(np.full(len(values) + 1, factor))
    back = np.multiply.accumulate(np.full(len(values) + 1, np.uint64(pow(base, -1, 1 << 64))))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:-1])])
    h = (run[hi] - run[lo]) * back[lo]
    h ^= h >> np.uint64(32)
    h *= MUL
    return h ^ (h >> np.uint64(29))


def word_anchors(texts: list[bytes], words: int = PASSAGE + 1, gram: int = WORD_GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the anchors of all runs of so many words, each once for a text. Words are what ASCII white space parts."""
    buf = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    blank = SPACE[buf]
    starts, ends = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    none = np.zeros(0, np.int64)
    if len(starts) < words:
        return none, none
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    of_text = np.searchsorted(text_ends, starts - 1, side="right")
    word = _window_hashes(buf.astype(np.uint64) + np.uint64(1), starts, ends, 0xD6E8FEB86659FD93)
    first = np.arange(len(starts) - gram + 1)
    least = _window_hashes(word, first, first + gram, 0xC2B2AE3D27D4EB4F)
    span, reach = words - gram + 1, 1
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if span > reach:
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
    n = len(starts) - words + 1
    least, which = least[:n], of_text[:n]
    inside = which == of_text[words - 1 :]
    least, which = least[inside], which[inside]
    if not len(least):
        return none, none
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (which[1:] != which[:-1])])
    pairs = np.unique(np.stack([which[new], least[new].view(np.int64)]), axis=1)
    return pairs[0], pairs[1]


def suffix_matches(rows: np.ndarray, group: np.ndarray, rank: np.ndarray, starts: int, length: int, keep_first: bool) -> np.ndarray:
    """Flags (row, column) of the starts whose length bytes match those of another row of the group (an earlier one, if keep_first).

    rows: bytes, aligned at the anchor; group: ascending; rank: the order of the rows' places in the corpus.
    """
    n, columns = rows.shape
    by_column = np.ascontiguousarray(rows.T)
    order = np.arange(n)
    differ = np.full(n + 1, columns, np.int64)
    flags = np.zeros((starts, n), bool)
    head = np.ones(n, bool)
    head[1:] = group[1:] != group[:-1]
    ends = group.astype(np.int64) << 8
    for c in range(columns - 1, -1, -1):
        key = ends + by_column[c][order]  # group is the same at every place of the order
        if not (key[1:] >= key[:-1]).all():
            perm = np.argsort(key, kind="stable")
            key = key[perm]
            jump = np.flatnonzero((perm[1:] != perm[:-1] + 1) & (key[1:] == key[:-1])) + 1
            order = order[perm]
            moved = differ[perm]
            if len(jump):
                bounds = np.stack([perm[jump - 1] + 1, perm[jump] + 1], axis=1).ravel()
                moved[jump] = np.minimum.reduceat(differ, bounds)[::2]
            differ[:n] = moved
        differ[0] = c
        differ[1:n][key[1:] != key[:-1]] = c
        if c < starts:
            same = differ[:n] - c >= length
            same &= ~head
            if keep_first:
                begins = np.flatnonzero(~same)
                least = np.minimum.reduceat(rank[order], begins)
                hit = rank[order] > np.repeat(least, np.diff(np.append(begins, n)))
            else:
                hit = same.copy()
                hit[:-1] |= same[1:]
            flags[c, order] = hit
    return flags.T


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows by (id0, row): a repeated row has the same key, and the same spans."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(-(1 << 63))).alias("id0"), F.xxhash64(doc_id, text).alias("row"), doc_id.alias("doc_id"), text.alias("text"))


def _zipped(keyed: DataFrame) -> DataFrame:
    """Texts compressed before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            z = pa.array([squeeze(t.as_buffer()) for t in b.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), z], ["id0", "row", "doc_id", "z"])

    return keyed.mapInArrow(run, "id0 long, row long, doc_id long, z binary")


def hot_verdicts(rows: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """(h, ahead, n_starts, digest, many, f0, f1, f2, runs) of distinct blocks, without their meeting in a task: which of their starts share
    length bytes with another block's (an earlier one's, if keep_first)."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        names = ["h", "ahead", "n_starts", "digest", "many", "f0", "f1", "f2", "start", "w0", "w1"]
        for b in batches:
            for at in range(0, b.num_rows, 256):
                t = b.slice(at, 256)
                bodies = [x.as_py() for x in t.column(3)]
                n_starts = t.column(2).to_numpy()
                row = np.repeat(np.arange(len(bodies)), n_starts)
                start = np.arange(len(row)) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts)
                raw = b"".join(xxhash.xxh3_128_digest(bodies[r][k : k + length]) for r, k in zip(row.tolist(), start.tolist(), strict=True))
                w = np.frombuffer(raw, "<i8").reshape(-1, 2)
                digests = np.array([xxhash.xxh64_intdigest(x, 42) for x in bodies], np.uint64).view(np.int64)
                own = [t.column(0).to_numpy(), t.column(1).to_numpy(), n_starts, digests, t.column(4).to_numpy() > 1, *(t.column(k).to_numpy() for k in (5, 6, 7))]
                cols = [*(c[row] for c in own), start.astype(np.int32), w[:, 0].copy(), w[:, 1].copy()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

    found = rows.select("h", "ahead", "n_starts", "block", "n", "f0", "f1", "f2").mapInArrow(
        windows, "h long, ahead int, n_starts int, digest long, many boolean, f0 long, f1 long, f2 int, start int, w0 long, w1 long"
    )
    found = stored(found, "hot-starts")
    place = F.struct("f0", "f1", (F.col("f2") + F.col("start")).alias("at"))
    # A row for each different string; checkpointed, so that the join has exchanges of its own and can split a hot one.
    same = checkpointed(found.groupBy("w0", "w1").agg(F.count("*").alias("same"), F.min(place).alias("first")).where("same > 1"))
    hit = found.join(same, ["w0", "w1"], "left")
    is_hit = F.coalesce((F.col("same") > 1) & (place != F.col("first")) if keep_first else (F.col("same") > 1) | F.col("many"), F.lit(False) if keep_first else F.col("many"))
    per = hit.groupBy("h", "ahead", "n_starts", "digest", "many", "f0", "f1", "f2").agg(F.array_sort(F.collect_list(F.when(is_hit, F.col("start")))).alias("starts"))
    # Runs of starts become byte ranges; at most length starts a block.
    runs = F.expr(
        f"""aggregate(starts, cast(array() as array<struct<lo:int,hi:int>>), (acc, x) ->
            if(size(acc) > 0 and element_at(acc, -1).hi = x - 1 + {length},
               concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).lo as lo, x + {length} as hi))),
               concat(acc, array(struct(x as lo, x + {length} as hi)))))"""
    )
    return per.withColumn("runs", runs).where("many or size(runs) > 0").drop("starts")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "none", passage: int = PASSAGE, hot_blocks: int = HOT) -> DataFrame:
    """(id0, row, spans array<struct<lo,hi>>, shared boolean): byte ranges covered by strings of length bytes that also start
    elsewhere, and whether another document has a passage of over passage words of this one; rows without either are left out.

    keep="none": every copy is covered; keep="first": all but the first copy by (doc_id, place).
    """
    if gram < 8 or gram & (gram - 1) or gram > length:
        raise ValueError("gram must be a power of two from 8 to length")
    keyed = _keyed(docs)
    starts = length - gram + 1

    word_gram = max(1, (passage + 1) * WORD_GRAM // (PASSAGE + 1))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id0", "row", "h", "words"]
        for b in batches:
            id0, row = b.column(0).to_numpy(), b.column(1).to_numpy()
            held, size, first = [], 0, 0
            for k in range(b.num_rows):
                held.append(b.column(2)[k].as_py().encode())
                size += len(held[-1])
                if size >= PIECE or k == b.num_rows - 1:
                    which, h, *_ = anchors(held, length, gram)
                    of_words, more = word_anchors(held, passage + 1, word_gram)
                    at, kind = first + np.concatenate([which, of_words]), np.repeat([False, True], [len(which), len(of_words)])
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (id0[at], row[at], np.concatenate([h, more]), kind)], names)
                    held, size, first = [], 0, k + 1

    found = stored(keyed.select("id0", "row", "text").mapInArrow(find, "id0 long, row long, h long, words boolean"), "anchors")
    owner = F.xxhash64("id0", "row")
    counts = found.groupBy("h", "words").agg(F.count("*").alias("n"), F.min(owner).alias("least"), F.max(owner).alias("largest"))
    # Checkpointed, so that the join has exchanges of its own and can split the rows of a hot anchor.
    again = checkpointed(counts.where("n > 1 and (not words or least <> largest)").select("h", "words"))
    per = found.join(again, ["h", "words"], "left_semi").groupBy("id0", "row")
    of_doc = stored(per.agg(F.collect_set(F.when(~F.col("words"), F.col("h"))).alias("anchors"), F.bool_or("words").alias("shared")), "shared-anchors")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out: list[tuple] = []
            for k in range(b.num_rows):
                text = expand(b.column(2)[k].as_py())
                id0, row = b.column(0)[k].as_py(), b.column(1)[k].as_py()
                # The places of its anchors are cheaper found again than shuffled.
                wanted, (_, h, at, lo, hi) = b.column(3)[k].values.to_numpy(), anchors([text], length, gram)
                own = np.isin(h, wanted)
                places = zip(h[own].tolist(), at[own].tolist(), lo[own].tolist(), hi[own].tolist(), strict=True)
                out += [(id0, row, x, a, p - x, y - x + 1, text[x : y + length]) for a, p, x, y in places]
                if len(out) >= 10_000 or (k == b.num_rows - 1 and out):
                    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["id0", "row", "lo", "h", "ahead", "n_starts", "block"])
                    out = []

    joined = _zipped(keyed).join(of_doc.where("size(anchors) > 0"), ["id0", "row"]).select("id0", "row", "z", "anchors")
    blocks = stored(joined.mapInArrow(cut, "id0 long, row long, lo int, h long, ahead int, n_starts int, block binary"), "blocks")
    own = ["h", "ahead", "n_starts", "digest"]
    digest = F.xxhash64("block")
    keep_first = keep == "first"
    place = F.min(F.struct("id0", "row", "lo"))
    counted = blocks.groupBy("h", "ahead", "n_starts", "block")
    distinct = (counted.agg(F.count("*").alias("n"), place.alias("f")) if keep_first else counted.agg(F.count("*").alias("n")).withColumn("f", F.expr("named_struct('id0', 0L, 'row', 0L, 'lo', 0)"))).select(
        "h", "ahead", "n_starts", "block", "n", F.col("f.id0").alias("f0"), F.col("f.row").alias("f1"), F.col("f.lo").alias("f2")
    )

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for t in whole_groups(batches, ["h"], AT_A_TIME):
            n = t.num_rows
            ahead, n_starts = t.column("ahead").to_numpy(), t.column("n_starts").to_numpy()
            rows = np.full((n, starts - 1 + length), NONE, np.uint8)
            bodies = [x.as_buffer() for x in t.column("block").combine_chunks()]
            for k, body in enumerate(bodies):
                a = starts - 1 - ahead[k]
                rows[k, a : a + len(body)] = np.frombuffer(body, np.uint8)
            h = t.column("h").to_numpy()
            group = np.concatenate([[0], np.cumsum(h[1:] != h[:-1])])
            rank = np.empty(n, np.int64)
            rank[np.lexsort([t.column(c).to_numpy() for c in ("f2", "f1", "f0")])] = np.arange(n)
            flags = suffix_matches(rows, group, rank, starts, length, keep_first)
            column = np.arange(starts)
            a = (starts - 1 - ahead)[:, None]
            flags &= (column >= a) & (column < a + n_starts[:, None])
            many = t.column("n").to_numpy() > 1
            if not keep_first:
                flags |= many[:, None] & (column >= a) & (column < a + n_starts[:, None])
            edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            k, lo = np.nonzero(edge == 1)
            _, hi = np.nonzero(edge == -1)
            lo, hi = lo - a[k, 0], hi - a[k, 0] - 1 + length
            runs: list[list] = [[] for _ in range(n)]
            for r, x, y in zip(k.tolist(), lo.tolist(), hi.tolist(), strict=True):
                runs[r].append({"lo": x, "hi": y})
            keep_rows = np.flatnonzero(many | flags.any(axis=1))
            if not len(keep_rows):
                continue
            digests = np.array([xxhash.xxh64_intdigest(bodies[r], 42) for r in keep_rows], np.uint64).view(np.int64)
            cols = [h[keep_rows], ahead[keep_rows], n_starts[keep_rows], digests, many[keep_rows], *(t.column(c).to_numpy()[keep_rows] for c in ("f0", "f1", "f2"))]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, cols), pa.array([runs[r] for r in keep_rows], pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))],
                ["h", "ahead", "n_starts", "digest", "many", "f0", "f1", "f2", "runs"],
            )

    verdicts = "h long, ahead int, n_starts int, digest long, many boolean, f0 long, f1 long, f2 int, runs array<struct<lo:int,hi:int>>"

    def ordered_of(rows: DataFrame) -> DataFrame:
        return rows.repartition("h").sortWithinPartitions("h").mapInArrow(order, verdicts)

    kinds = blocks.select("h", "ahead", "n_starts", digest.alias("digest")).distinct()
    hot = checkpointed(kinds.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > hot_blocks).select("h"))
    n_hot = hot.count()
    if n_hot:
        anchors_of = F.broadcast(hot) if n_hot <= MOST_BROADCAST else hot
        told = hot_verdicts(distinct.join(anchors_of, "h", "left_semi"), length, keep_first).select(*[x.split()[0] for x in verdicts.split(", ")])
        ordered = ordered_of(distinct.join(anchors_of, "h", "left_anti")).unionByName(told)
    else:
        ordered = ordered_of(distinct)
    slim = blocks.select("id0", "row", "lo", "h", "ahead", "n_starts", digest.alias("digest"))
    both = slim.join(ordered, own)
    runs = F.col("runs")
    if keep_first:
        is_first = (F.col("id0") == F.col("f0")) & (F.col("row") == F.col("f1")) & (F.col("lo") == F.col("f2"))
        runs = F.when(F.col("many") & ~is_first, F.array(F.struct(F.lit(0).alias("lo"), (F.col("n_starts") - 1 + length).alias("hi")))).otherwise(runs)
    covered = both.select("id0", "row", F.col("lo").alias("at"), F.explode(runs).alias("run")).select(
        "id0", "row", F.struct((F.col("at") + F.col("run.lo")).alias("lo"), (F.col("at") + F.col("run.hi")).alias("hi")).alias("span"), F.lit(False).alias("shared")
    )
    others = of_doc.where("shared").select("id0", "row", F.lit(None).cast(covered.schema["span"].dataType).alias("span"), "shared")
    return covered.unionByName(others).groupBy("id0", "row").agg(F.collect_set("span").alias("spans"), F.bool_or("shared").alias("shared"))


def substring_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "none", with_text: bool = True, passage: int = PASSAGE, hot_blocks: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256, shared[, text]) for each row of docs.

    spans: maximal byte ranges [lo, hi) that are removed; text: what is left (a character that is cut is
    dropped). shared: whether another document has a passage of over passage words of this one, also where it is too short
    to be removed; every such passage counts, and shorter ones from about 0.7 of that may. Null text counts as empty, and texts
    shorter than length lose nothing. Rows that repeat, with the same or no doc_id, are documents of their own and match
    each other; with keep="first", and for shared, rows that are the same in both doc_id and text count as one
    document. An empty table gives an empty table; other columns are not read.
    """
    spans = repeated_spans(docs, length, gram, keep, passage, hot_blocks)
    joined = _zipped(_keyed(docs)).join(spans, ["id0", "row"], "left").select("doc_id", "z", "spans", F.coalesce("shared", F.lit(False)).alias("shared"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        names = ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "shared", *(["text"] if with_text else [])]
        for b in batches:
            out = []
            for doc_id, z, found, shared in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                text = expand(z.as_py())
                merged: list[list[int]] = []
                for lo, hi in sorted((x["lo"], x["hi"]) for x in found or []):
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                kept, at = [], 0
                for lo, hi in merged:
                    kept.append(text[at:lo])
                    at = hi
                rest = b"".join([*kept, text[at:]])
                out.append((doc_id, len(text), len(text) - len(rest), [{"lo": x, "hi": y} for x, y in merged], hashlib.sha256(rest).hexdigest(), shared, *([rest.decode(errors="ignore")] if with_text else [])))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.string(), pa.bool_(), pa.string()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=False)], names)

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, spans array<struct<lo:long,hi:long>>, kept_sha256 string, shared boolean" + (", text string" if with_text else ""))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "shared")
