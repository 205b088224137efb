"""Fuzzy line deduplication by MinHash.

1. Lines of all documents become keys (stripped, lower case), a key its 64-bit hash. Equal keys are one line from here on.
2. A key's characters give shingles of SHINGLE characters, and these a MinHash signature of BINS values in each of
   PASSES hash functions (one-permutation hashing; an empty bin takes the value of the next filled one). BANDS
   bands of ROWS values are high-recall bands: keys of Jaccard similarity s meet in one with probability
   1 - (1 - s ** ROWS) ** BANDS, 0.995 at 0.8 and over 0.9999 at 0.9.
3. Bands are sorted by value, and each key is paired with the first two keys of its bucket, in an order that is random
   in each band: pairs grow with the rows and never with the square of a bucket. Buckets of up to three keys are
   compared in full by that.
4. Pairs are verified by the exact Jaccard similarity of their shingle sets (THRESHOLD or more; shingles are compared as
   64-bit hashes), and verified pairs are joined by distributed union-find.
5. Buckets of more keys that are still in several components are searched exactly for links between these: all are
   compared with a pivot, and by the triangle inequality of the Jaccard distance only keys within twice the
   distance of the pivot can link to one that is near it. Buckets of more than CHUNK keys are cut into chunks, and
   each two chunks are searched in a task of their own. Then components are joined again.
6. Of the lines of a component the first, by doc_id and line number, stays. The texts of candidates are found again by
   a bitmap of fixed size, the only thing broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import checkpointed, components, stored, table, whole_groups
from quire.llm.suffix_dedup import _keyed, _zipped

SHINGLE = 8
THRESHOLD = 0.8
PASSES = 2
BINS = 20
ROWS = 4
BANDS = PASSES * BINS // ROWS
BITS = 1 << 26
CHUNK = 2_000
PIECE = 1 << 20
#: Characters whose signatures are made at a time; more leave the processor's cache and take twice as long.
SLICE = 1 << 16

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def keys_of(text: str | None) -> list[str]:
    return [line.strip() for line in (text or "").lower().split("\n")]


def hash_of(key: str) -> int:
    import xxhash

    h = xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def shingle_hashes(keys: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the shingles of all keys, one after another; shingles of each key, repeats included)."""
    size = np.array([len(k) for k in keys], np.int64)
    cp = np.frombuffer("".join(keys).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    h, wide = (cp + np.uint64(1)) * ODD[0], 1
    h ^= h >> np.uint64(32)
    while wide < shingle:
        h = h[:-wide] * ODD[1] + h[wide:]
        h ^= h >> np.uint64(29)
        wide *= 2
    counts = np.maximum(size - shingle + 1, 0)
    # The last places of a key begin no shingle of its own.
    valid, ends = np.ones(len(h), bool), np.cumsum(size)
    for back in range(1, shingle):
        at = ends - back
        valid[at[(at >= 0) & (at < len(h))]] = False
    return h[valid], counts


def shingle_sets(keys: list[str], shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each key."""
    h, counts = shingle_hashes(keys, shingle)
    ends = np.cumsum(counts)
    out = []
    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        own = np.sort(h[a:b])
        out.append(own if len(own) < 2 else own[np.concatenate([[True], own[1:] != own[:-1]])])
    return out


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets, neither empty."""
    at = np.searchsorted(a, b)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return both / (len(a) + len(b) - both)


def signatures(keys: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """(keys, PASSES * BINS) MinHash values; every key has shingle characters at least."""
    grams, counts = shingle_hashes(keys, shingle)
    which = np.repeat(np.arange(len(keys)), counts)
    out = np.empty((len(keys), PASSES * BINS), np.uint32)
    top = np.uint32(0xFFFFFFFF)
    base = which * BINS
    for p in range(PASSES):
        x = (grams ^ (grams >> np.uint64(31))) * ODD[2 + p]
        x ^= x >> np.uint64(32)
        least = np.full(len(keys) * BINS, top)
        bin_ = ((x & np.uint64(0xFFFFFFFF)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(least, base + bin_, (x >> np.uint64(32)).astype(np.uint32))
        least = least.reshape(-1, BINS)
        for _ in range(BINS - 1):
            empty = least == top
            if not empty.any():
                break
            least = np.where(empty, np.where(np.roll(empty, -1, axis=1), top, np.roll(least, -1, axis=1) * np.uint32(ODD[3] & np.uint64(0xFFFFFFFF)) & np.uint32(0xFFFFFFFE)), least)
        out[:, p * BINS : (p + 1) * BINS] = least
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """(keys, BANDS) signed 64-bit values; the band's number is part of each."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * ODD[4], parts.shape[:2]).copy()
    for r in range(ROWS):
        h = (h ^ parts[:, :, r]) * ODD[5]
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def bands_of(keys: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """bands(signatures(keys)), made in slices of about SLICE characters."""
    out, at, size = [], 0, 0
    for k, key in enumerate(keys, 1):
        size += len(key)
        if size >= SLICE or k == len(keys):
            out.append(bands(signatures(keys[at:k], shingle)))
            at, size = k, 0
    return np.concatenate(out)


#: Sets that are compared one by one before the others are at once.
TRIED = 6


def links(sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Links (of threshold or more) that join every component of the sets, without comparing all pairs."""
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    size = np.array([len(s) for s in sets])
    out: list[tuple[int, int]] = []
    left, parts = np.arange(len(sets)), len(sets)
    # The shingles of all sets as numbers from 0, so that whether a pivot has them is read from a table.
    number = np.unique(np.concatenate(sets), return_inverse=True)[1] if len(sets) > 1 else np.zeros(0, np.int64)
    ends = np.cumsum(size)
    has = np.zeros(int(number.max()) + 1 if len(number) else 0, bool)
    values = number
    while len(left) > 1 and parts > 1:
        p, left = int(left[0]), left[1:]
        pivot, values = sets[p], values[size[p] :]
        own = number[ends[p] - size[p] : ends[p]]
        has[own] = True
        both = np.add.reduceat(has[values].astype(np.int32), np.cumsum(size[left]) - size[left])
        has[own] = False
        alike = both / (size[left] + len(pivot) - both)
        near = left[alike >= threshold]
        near = near[np.argsort(-alike[alike >= threshold], kind="stable")].tolist()
        for x in near:
            if find(x) != find(p):
                root[find(x)] = find(p)
                parts -= 1
                out.append((p, x))
        between = left[(alike < threshold) & (alike >= 2 * threshold - 1)].tolist() if near else []
        rest = np.array(near[TRIED:], np.int64)
        flat = np.concatenate([number[ends[y] - size[y] : ends[y]] for y in rest]) if len(rest) and between else None
        for x in between:
            if find(x) == find(p):
                continue
            hit = next((y for y in near[:TRIED] if jaccard(sets[x], sets[y]) >= threshold), None)
            if hit is None and flat is not None:  # the others, all at once
                own = number[ends[x] - size[x] : ends[x]]
                has[own] = True
                both = np.add.reduceat(has[flat].astype(np.int32), np.cumsum(size[rest]) - size[rest])
                has[own] = False
                found = np.flatnonzero(both / (size[x] + size[rest] - both) >= threshold)
                hit = int(rest[found[0]]) if len(found) else None
            if hit is not None:
                root[find(x)] = find(p)
                parts -= 1
                out.append((x, hit))
        away = alike < threshold
        values, left = values[np.repeat(away, size[left])], left[away]
    return out


def line_components(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(occurrences (id0, row, n, h), roots (node, root)) of all non-empty lines; h without a root is alone."""
    spark = docs.sparkSession
    keyed = _keyed(docs)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for id0, row, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                out += [(id0, row, n, hash_of(k)) for n, k in enumerate(keys_of(t.as_py())) if k]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)], ["id0", "row", "n", "h"])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[int, str] = {}
            size = 0
            for k, t in enumerate(b.column(0)):
                for key in keys_of(t.as_py()):
                    if len(key) >= shingle and (h := hash_of(key)) not in seen:
                        seen[h] = key
                        size += len(key)
                if seen and (size >= PIECE or k == b.num_rows - 1):
                    value = bands_of(list(seen.values()), shingle)
                    yield pa.RecordBatch.from_arrays([pa.array(value.ravel()), pa.array(np.repeat(np.fromiter(seen, np.int64, len(seen)), BANDS))], ["band", "h"])
                    seen, size = {}, 0

    occurrences = stored(keyed.select("id0", "row", "text").mapInArrow(lines, "id0 long, row long, n int, h long"), "lines")
    # One row for each band and key of a piece of text; the order within a band is random in h.
    dealt = keyed.select("text").mapInArrow(sign, "band long, h long").repartition("band").sortWithinPartitions("band", F.xxhash64("band", "h"))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, list[int], int] | None = None  # the band at the end of the last batch, its first two keys and its keys so far
        before = None
        for b in batches:
            if not b.num_rows:
                continue
            band, h = b.column(0).to_numpy(), b.column(1).to_numpy()
            same = np.zeros(len(band), bool)  # one key from several pieces stands side by side
            same[1:] = (band[1:] == band[:-1]) & (h[1:] == h[:-1])
            same[0] = before == (band[0], h[0])
            before = band[-1], h[-1]
            band, h = band[~same], h[~same]
            if not len(band):
                continue
            start = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
            size = np.diff(np.append(start, len(band)))
            one, two = h[start].copy(), h[np.minimum(start + 1, start + size - 1)].copy()
            place = np.arange(len(band)) - np.repeat(start, size)
            if last and last[0] == band[0]:
                place[: size[0]] += last[2]
                one[0], two[0] = last[1][0], last[1][1] if len(last[1]) > 1 else h[0]
            ends = [int(one[-1]), int(two[-1])] if place[-1] else [int(h[-1])]
            last = int(band[-1]), ends, int(place[-1]) + 1
            keep = place > 0
            if keep.any():
                cols = [band[keep], place[keep], h[keep], np.repeat(one, size)[keep], np.repeat(two, size)[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["band", "place", "h", "one", "two"])

    members = stored(dealt.mapInArrow(pair, "band long, place long, h long, one long, two long"), "line-buckets")
    pairs = members.select(F.explode(F.array(F.struct(F.least("h", "one").alias("a"), F.greatest("h", "one").alias("b")), F.struct(F.least("h", "two").alias("a"), F.greatest("h", "two").alias("b")))).alias("p"))
    pairs = checkpointed(pairs.select("p.a", "p.b").where("a <> b").distinct())
    slot = F.pmod(F.col("h"), F.lit(bits))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    words = ends.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("marks")).toArrow()
    marks = np.zeros(bits // 64, np.int64)
    marks[words.column("word").to_numpy()] = words.column("marks").to_numpy()
    sent = spark.sparkContext.broadcast(marks)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(sent.value.view(np.uint8), bitorder="little").view(bool) if bits <= 1 << 22 else None
        words_ = sent.value
        for b in batches:
            out: dict[int, str] = {}
            for t in b.column(0):
                for key in keys_of(t.as_py()):
                    if len(key) >= shingle:
                        h = hash_of(key)
                        s = h % bits
                        if marked[s] if marked is not None else int(words_[s >> 6]) >> (s & 63) & 1:
                            out[h] = key
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.string())], ["h", "key"])

    found = keyed.select("text").mapInArrow(fetch, "h long, key string").groupBy("h").agg(F.min("key").alias("key"))
    found = found.join(ends, "h", "left_semi")
    texts = stored(found, "line-keys")
    both = pairs.join(texts.select(F.col("h").alias("a"), F.col("key").alias("left")), "a").join(texts.select(F.col("h").alias("b"), F.col("key").alias("right")), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                b = whole.slice(at, 2_000)
                keys = pa.chunked_array([b.column(2), b.column(3)]).combine_chunks().dictionary_encode()
                sets, code = shingle_sets(keys.dictionary.to_pylist(), shingle), keys.indices.to_numpy()
                ok = [jaccard(sets[x], sets[y]) >= threshold for x, y in zip(code[: b.num_rows], code[b.num_rows :], strict=True)]
                yield from pa.Table.from_batches([b.select(["a", "b"])]).filter(pa.array(ok, pa.bool_())).to_batches()

    verified = checkpointed(both.select("a", "b", "left", "right").mapInArrow(verify, "a long, b long"))
    roots = checkpointed(components(verified))

    # Large buckets that are in several components yet.
    large = members.join(members.where("place = 3").select("band"), "band", "left_semi")
    of_band = large.select("band", "h").unionByName(large.where("place = 1").select("band", F.col("one").alias("h")))
    labelled = of_band.join(roots, of_band.h == roots.node, "left").select("band", "h", F.coalesce("root", "h").alias("root"))
    split = labelled.groupBy("band").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    mine = F.pmod(F.xxhash64("h"), F.col("chunks")).cast("int")
    dealt = labelled.join(split, "band").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.join(texts, "h").select("band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "h", "key")
    dealt = dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["band", "i", "j"], 5_000):
            at = [np.asarray(t.column(c)) for c in ("band", "i", "j")]
            cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in at], axis=0)) + 1
            # A key stands in several bands and chunks; its set is made once.
            h, coded = t.column("h").to_numpy(), t.column("key").combine_chunks().dictionary_encode()
            own, which = shingle_sets(coded.dictionary.to_pylist(), shingle), coded.indices.to_pylist()
            a: list[int] = []
            b: list[int] = []
            for lo, hi in zip([0, *cut], [*cut, t.num_rows], strict=True):
                for x, y in links([own[k] for k in which[lo:hi]], threshold):
                    a.append(h[lo + x])
                    b.append(h[lo + y])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    more = checkpointed(dealt.mapInArrow(search, "a long, b long"))
    return occurrences, components(more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def line_verdicts(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(id0, row, gone array<int>): the numbers of the lines that go, for the documents that lose some."""
    occurrences, roots = line_components(docs, threshold, shingle, bits)
    # Most lines are alone: only those with an equal or linked one take part in what follows.
    again = occurrences.groupBy("h").agg(F.count("*").alias("many")).where("many > 1").select("h")
    roots = checkpointed(roots)
    comp = again.join(roots, again.h == roots.node, "left_anti").select("h", F.col("h").alias("root")).unionByName(roots.select(F.col("node").alias("h"), "root"))
    shared = checkpointed(occurrences.join(comp, "h").select("root", "id0", "row", "n"))
    # Checkpointed, so that the join has exchanges of its own and can split a large component.
    first = checkpointed(shared.groupBy("root").agg(F.min(F.struct("id0", "n", "row")).alias("first")))
    return shared.join(first, "root").where("not (id0 = first.id0 and n = first.n and row = first.row)").groupBy("id0", "row").agg(F.sort_array(F.collect_set("n")).alias("gone"))


def line_dedup(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, bits: int = BITS, with_text: bool = True) -> DataFrame:
    """(doc_id, n_lines, n_removed, gone array<int>, kept_sha256[, text]), one row for each row of docs.

    A line ends at a newline; empty lines always stay and are not counted as copies. Keys shorter than
    shingle characters are only compared exactly. Null text counts as one empty line. Rows that repeat both
    doc_id and text share their verdicts (both keep a line that only they have). An empty table gives an
    empty table; other columns are not read.
    """
    verdicts = line_verdicts(docs, threshold, shingle, bits)
    joined = _zipped(_keyed(docs)).join(verdicts, ["id0", "row"], "left").select("doc_id", "z", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for doc_id, z, gone in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                all_lines = expand(z.as_py()).decode().split("\n")
                off = set(gone or [])
                rest = "\n".join(x for n, x in enumerate(all_lines) if n not in off)
                out.append((doc_id, len(all_lines), len(off), sorted(off), hashlib.sha256(rest.encode()).hexdigest(), *([rest] if with_text else [])))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string(), pa.string()]
            if out:
                names = ["doc_id", "n_lines", "n_removed", "gone", "kept_sha256", *(["text"] if with_text else [])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=False)], names)

    return joined.mapInArrow(run, "doc_id long, n_lines long, n_removed long, gone array<int>, kept_sha256 string" + (", text string" if with_text else ""))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_lines", "n_removed", F.array_join(F.transform("gone", lambda x: x.cast("string")), ",").alias("removed_lines"), "kept_sha256")
