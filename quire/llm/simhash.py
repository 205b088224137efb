"""SimHash near-deduplication by a binary-trie self-join.

Fingerprints of 64 bits stand in a binary trie. The self-join walks pairs of nodes down the trie together,
adds up the bits in which the two paths differ and leaves a pair as soon as the error budget is exceeded.

To spread the walk over tasks, the 64 bits are cut into budget + 1 blocks: two fingerprints within the
budget agree on one block at least, so each block's values are the upper levels of a trie of their own
and each value's subtrie is walked apart (bits rotated so that the block comes first). A value that holds
more than CHUNK fingerprints is cut into chunks, and each pair of chunks is walked in its own task.
Subtries whose fingerprints are already linked to one component are not walked again, so a dense group
yields its spanning links and not all its pairs. Links are joined by distributed union-find.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import by_batch, checkpointed, components, table, whole_groups

WORDS = 3
SEED = 42
BUDGET = 3
CHUNK = 20_000
#: Node pairs that are walked at a time.
FRONT = 1 << 19


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The signed 64-bit SimHash of a text; zero if it has no words. Null counts as empty."""
    import xxhash

    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    body = b" ".join(parts)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    h64 = xxhash.xxh64_intdigest
    if len(parts) <= words:
        hashes = [h64(body, seed)]
    else:
        hashes = [h64(body[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[words - 1 :].tolist(), strict=True)]
    total = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        total += np.unpackbits(np.array(hashes[at : at + (1 << 15)], ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp long): one row for each row of docs."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(t, words, seed) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(by_batch(one), "doc_id long, fp long")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def _settle(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """labels after joining a to b: the least index of each component."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up
    return labels


def trie_join(fps: np.ndarray, group: np.ndarray, side: np.ndarray, top: int, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (indices a, b) between fingerprints within budget bits of each other in one group.

    fps: uint64, distinct in a group, ordered by (group, side, fp). side 0 and 1: links are only sought
    between the two sides of a group; a group whose rows all have side 0 is joined with itself. The bits
    from top on are the same throughout a group.
    """
    n = len(fps)
    labels = np.arange(n)
    if n < 2:
        return labels[:0], labels[:0]
    zeros = np.zeros((1,), np.int64)
    key_change = np.flatnonzero((group[1:] != group[:-1]) | (side[1:] != side[:-1])) + 1
    lo = np.concatenate([zeros, key_change])
    hi = np.concatenate([key_change, [n]])
    two = np.flatnonzero((side[lo[:-1]] == 0) & (side[lo[1:]] == 1) & (group[lo[:-1]] == group[lo[1:]]))
    single = np.ones(len(lo), bool)
    single[two] = single[two + 1] = False
    single &= side[lo] == 0
    pairs = np.concatenate(
        [np.stack([lo[single], hi[single], lo[single], hi[single]]), np.stack([lo[two], hi[two], lo[two + 1], hi[two + 1]])], axis=1
    )
    # Neighbours in order link dense groups at once, so that their subtries need no walk.
    near = np.flatnonzero((group[1:] == group[:-1]) & (side[1:] == side[:-1]) & (_popcount(fps[1:] ^ fps[:-1]) <= budget))
    labels = _settle(labels, near, near + 1)
    stack = [(pairs, np.zeros(pairs.shape[1], np.int64), top - 1)]
    while stack:
        (alo, ahi, blo, bhi), err, bit = stack.pop()
        turn = np.concatenate([zeros, np.cumsum(labels[1:] != labels[:-1])])
        linked = (labels[alo] == labels[blo]) & (turn[ahi - 1] == turn[alo]) & (turn[bhi - 1] == turn[blo])
        small = (ahi - alo) * (bhi - blo) <= 4
        ends = ~linked & (small | (bit < 0))
        if ends.any():
            for i in range(4 if bit >= 0 else 1):
                wide = np.maximum(bhi[ends] - blo[ends], 1)
                a, b = alo[ends] + i // wide, blo[ends] + i % wide
                ok = (a < ahi[ends]) & (b < bhi[ends])
                a, b = a[ok], b[ok]
                hit = (a != b) & (_popcount(fps[a] ^ fps[b]) <= budget)
                labels = _settle(labels, a[hit], b[hit])
        walk = ~linked & ~ends
        if bit < 0 or not walk.any():
            continue
        alo, ahi, blo, bhi, err = alo[walk], ahi[walk], blo[walk], bhi[walk], err[walk]
        ones = np.concatenate([zeros, np.cumsum((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)])
        amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
        same = (alo == blo) & (ahi == bhi)
        kids = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1)]
        other = ~same
        kids.append((amid[other], ahi[other], blo[other], bmid[other], err[other] + 1))
        pairs = np.concatenate([np.stack(k[:4]) for k in kids], axis=1)
        err = np.concatenate([k[4] for k in kids])
        keep = (pairs[1] > pairs[0]) & (pairs[3] > pairs[2]) & (err <= budget)
        pairs, err = pairs[:, keep], err[keep]
        for at in range(0, pairs.shape[1], FRONT):
            stack.append((pairs[:, at : at + FRONT], err[at : at + FRONT], bit - 1))
    out = np.flatnonzero(labels != np.arange(n))
    return out, labels[out]


def _rotated(fp: np.ndarray, by: int) -> np.ndarray:
    return (fp << np.uint64(by)) | (fp >> np.uint64(64 - by)) if by else fp


def hamming_links(distinct: DataFrame, budget: int = BUDGET, chunk: int = CHUNK) -> DataFrame:
    """(a long, b long) from distinct fingerprints (fp long): links that span every component of the pairs within budget."""
    blocks = budget + 1
    if 64 % blocks:
        raise ValueError("budget + 1 must divide 64")
    width = 64 // blocks
    spread = distinct.select(F.col("fp"), F.posexplode(F.array(*[F.expr(f"shiftrightunsigned(fp, {64 - width * (k + 1)}) & {(1 << width) - 1}L") for k in range(blocks)])).alias("block", "value"))
    counts = spread.groupBy("block", "value").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    met = spread.join(counts, ["block", "value"]).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    # Chunk i is joined with itself and with every other chunk; a row of the pair (i, j) is on side 0 or 1.
    dealt = met.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select(
        "fp", "block", F.xxhash64("block", "value", F.least("mine", "other"), F.greatest("mine", "other")).alias("part"), (F.col("mine") > F.col("other")).cast("int").alias("side")
    )
    dealt = dealt.repartition("block", "part").sortWithinPartitions("block", "part", "side")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["block", "part"]):
            block = t.column("block").to_numpy()
            for k in np.unique(block):
                of = block == k
                fps = _rotated(t.column("fp").to_numpy()[of].view(np.uint64), width * int(k))
                part, side = t.column("part").to_numpy()[of], t.column("side").to_numpy()[of].astype(np.int64)
                order = np.lexsort((fps, side, part))
                fps, part, side = fps[order], part[order], side[order]
                a, b = trie_join(fps, part, side, 64 - width, budget)
                back = _rotated(fps, (64 - width * int(k)) % 64).view(np.int64)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(back[a]), pa.array(back[b])], ["a", "b"])

    return dealt.mapInArrow(walk, "a long, b long")


def simhash_groups(docs: DataFrame, words: int = WORDS, budget: int = BUDGET, seed: int = SEED) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id that links of at most budget bits reach.

    One row for each row of docs. Null text counts as empty; texts without words have fingerprint zero and
    are linked like any other. Null doc_ids get the component_id of their group (null if all are null).
    An empty table gives an empty table; columns other than doc_id and text are not read.
    """
    fps = checkpointed(fingerprints(docs, words, seed))
    distinct = checkpointed(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(hamming_links(distinct.select("fp"), budget))
    joined = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    linked = joined.join(roots.select("root").distinct(), "root", "left_semi")
    first = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = joined.join(first, "root", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return fps.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """docs without the documents that are near copies of one with a smaller doc_id; all columns stay.

    Rows without doc_id stay. Rows that repeat a doc_id stay or go together, as one of them links to a smaller id or none
    does. Null and empty texts are copies of each other, so the one with the smallest doc_id stays. An empty table stays empty.
    """
    away = simhash_groups(docs, words, budget).where("doc_id <> component_id").select(F.col("doc_id").alias("__quire_away")).distinct()
    return docs.join(away, docs.doc_id == F.col("__quire_away"), "left_anti")
