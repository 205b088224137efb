"""Token ids in a binary store: fixed-size id blocks cut into bit or byte planes, each compressed with zstandard.

Format. Documents are written in ascending doc_id order (nulls first, ties by text) as range-partitioned
parts. A part is a sequence of chunks; a chunk holds whole documents, so that it can be read alone:

    part, chunk        place in the order
    first              ids of the part before this chunk
    n_ids, block       ids in the chunk, ids of a block (the last one may be shorter)
    kind               'byte' (4 planes: byte k of every id) or 'bit' (32 planes: bit k, packed)
    doc_ids, lens      its documents and how many ids each has
    index              little-endian uint32 length of each compressed plane, block by block; 0: all zero
    payload            the planes, one zstandard frame each

Chunks are rows of uncompressed Parquet files in the folder that all executors share: that gives atomic
commits, retries and readers for any store that Spark reaches, while ids are only in this format.
"""

from __future__ import annotations

import gc
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import partitions_for, stored, table, worker_kept

END_ID = 1
BLOCK = 1 << 16
CHUNK_IDS = 1 << 18
LEVEL = 3
#: Pieces whose ids a worker remembers in either of two generations; when the younger is full it becomes the older one,
#: and what is met again moves back to the younger.
REMEMBERED = 400_000
#: Longer pieces (bytes) are not remembered, so that memory is bounded by pieces of this size.
LONGEST = 64

CHUNK_SCHEMA = "part int, chunk int, first long, n_ids long, block int, kind string, doc_ids array<long>, lens array<long>, index binary, payload binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: What is surely one pre-token, or one and a run of signs: letters without combining marks, then signs other than the apostrophe.
SIGNS = b".,;:!?$%&#*"
PLAIN = re.compile("^([a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u017e]+)([.,;:!?$%&#*]*)$|^(.*)$", re.M)
#: The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the others from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LEVEL = {b: (b if b in _PRINTED else 256 + sum(x not in _PRINTED for x in range(b))) for b in range(256)}


def _little(ids: array) -> array:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


# How a tokenizer that encodes pieces between white space apart normalizes and splits.
APART_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
APART_SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
APART_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def encodes_apart(path: str) -> bool:
    """Whether the tokenizer in a file is known to give a text the ids of its pieces between white space, one after another."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    normalizer, splitter, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
    return (
        normalizer.get("normalizers") == APART_NORMALIZER
        and splitter.get("pretokenizers") == [APART_SPLIT, APART_BYTES]
        and model.get("type") == "BPE" and bool(model.get("end_of_word_suffix")) and not model.get("dropout")
        and not any(c.isspace() or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens") or [] for c in t["content"])
    )


class Encoder:
    """Texts to ids (little-endian uint32 bytes).

    A tokenizer for which encodes_apart doesn't hold encodes whole texts. Else it splits at white space, and between letters
    and signs, so every piece is encoded once and remembered, unless it is over LONGEST bytes. New plain words, and signs, are
    one pre-token each and go to the tokenizer's model as such; any other kind of piece is encoded like a text.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.apart = encodes_apart(path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.plain: dict[bytes, bytes] = {}
        self.old: tuple[dict, dict] = {}, {}
        self.remembered = remembered

    def _one_by_one(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _plain(self, word: bytes) -> bytes:
        shown = word.decode() if word.isascii() else word.decode("latin-1").translate(BYTE_LEVEL)
        return _little(array("I", [t.id for t in self.model.tokenize(shown)])).tobytes()

    def _learn(self, new: list[bytes]) -> None:
        known, plain = self.known, self.plain
        parts: list[tuple[bytes, bytes, bytes]] = []
        other, rest = [], []
        for p in new:
            letters = p.rstrip(SIGNS)
            if len(p) > LONGEST:
                other.append(p)
            elif letters.isalpha():  # letters of ASCII
                parts.append((p, letters.lower(), p[len(letters) :]))
            else:
                rest.append(p)
        if rest:  # one piece a line, so that one pass of the pattern takes all of them; plain words are lower-cased by that
            for p, (a, b, whole) in zip(rest, PLAIN.findall(b"\n".join(rest).decode().lower()), strict=True):
                if whole:
                    other.append(p)
                else:
                    parts.append((p, a.encode(), b.encode()))
        words = {a for _, a, _ in parts}
        words.update([b for _, _, b in parts])
        words.discard(b"")
        plain[b""] = b""
        for w in self._recalled(words.difference(plain), plain, self.old[1]):
            plain[w] = self._plain(w)
        known.update([(p, plain[a] + plain[b]) for p, a, b in parts])
        if other:
            known.update(zip(other, self._one_by_one([p.decode() for p in other]), strict=True))

    @staticmethod
    def _recalled(wanted: set, young: dict, old: dict) -> set:
        """What of wanted is in neither generation; the rest is in the younger one after this."""
        back = old.keys() & wanted
        young.update(zip(back, map(old.__getitem__, back), strict=True))
        return wanted - back

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if not self.apart:
            return self._one_by_one([t or "" for t in texts])
        words = [(t or "").encode().split() for t in texts]
        if len(self.known) > self.remembered or len(self.plain) > self.remembered:
            self.old, self.known, self.plain = (self.known, self.plain), {}, {}
        known = self.known
        new = self._recalled(set().union(*words).difference(known), known, self.old[0])
        if new:
            self._learn(list(new))
        out = [b"".join(map(known.__getitem__, ws)) for ws in words]
        for p in new:
            if len(p) > LONGEST:
                del known[p]
        return out


def to_planes(ids: np.ndarray, kind: str) -> np.ndarray:
    """(planes, bytes of a plane) of uint32 ids."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return np.ascontiguousarray(octets.T)
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")


def from_planes(planes: np.ndarray, n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        return np.ascontiguousarray(planes.T).view("<u4").ravel()
    bits = np.unpackbits(planes, axis=1, count=n, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u4").ravel()


def pack(ids: np.ndarray, block: int = BLOCK, kind: str = "byte", level: int = LEVEL) -> tuple[bytes, bytes]:
    """(index, payload) of a chunk of ids."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
    frames = []
    for at in range(0, len(ids), block):
        frames += [squeeze(p.tobytes()) if p.any() else b"" for p in to_planes(ids[at : at + block], kind)]
    return np.array([len(f) for f in frames], "<u4").tobytes(), b"".join(frames)


def unpack(index: bytes, payload: bytes, n_ids: int, block: int, kind: str) -> np.ndarray:
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    n_planes = 4 if kind == "byte" else 32
    ends = np.cumsum(np.frombuffer(index, "<u4"))
    out, k, at = [], 0, 0
    for start in range(0, n_ids, block):
        n = min(block, n_ids - start)
        planes = np.zeros((n_planes, n if kind == "byte" else (n + 7) // 8), np.uint8)
        for p in range(n_planes):
            if ends[k] > at:
                planes[p] = np.frombuffer(expand(payload[at : ends[k]]), np.uint8)
            at, k = int(ends[k]), k + 1
        out.append(from_planes(planes, n, kind))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def write_tokens(
    docs: DataFrame, tokenizer: str | None = None, end_id: int | None = END_ID, block: int = BLOCK, chunk_ids: int = CHUNK_IDS, kind: str = "byte", level: int = LEVEL, partitions: int | None = None
) -> DataFrame:
    """The chunks of docs (doc_id, text), written to the shared folder and read back as a table of chunks.

    tokenizer: the path of a tokenizers file, the same on all executors. Every row is encoded whole; null text counts as
    empty (the end id alone). Rows that repeat a doc_id, or have none, stand beside each other, ordered by text. An empty table gives no chunks. Other columns are not read.
    """
    path = tokenizer or default_tokenizer()
    n = partitions or partitions_for(docs.select("doc_id", "text"))
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = worker_kept(f"encoder {path}", lambda: Encoder(path)), TaskContext.get().partitionId()
        gc.freeze()
        tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        names = [x.split()[0] for x in CHUNK_SCHEMA.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        held: list[tuple[int | None, bytes]] = []
        size = first = chunk = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(b for _, b in held), "<u4")
            index, payload = pack(ids, block, kind, level)
            row = (part, chunk, first, len(ids), block, kind, [d for d, _ in held], [len(b) // 4 for _, b in held], index, payload)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                for doc_id, ids in zip(piece.column(0).to_pylist(), encode(piece.column(1).to_pylist()), strict=True):
                    held.append((doc_id, ids + tail))
                    size += len(ids + tail) // 4
                    if size >= chunk_ids:
                        yield flush()
                        first, chunk, size = first + size, chunk + 1, 0
                        held.clear()
        if held:
            yield flush()

    return stored(ordered.mapInArrow(write, CHUNK_SCHEMA), "tokens", "uncompressed")


def read_tokens(chunks: DataFrame, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids array<int>]) from a table of chunks, one row for each document written."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["index"], row["payload"], row["n_ids"], row["block"], row["kind"])
                ends = np.cumsum(np.array(row["lens"], np.int64))
                starts = ends - np.array(row["lens"], np.int64)
                own = [ids[a:b] for a, b in zip(starts, ends, strict=True)]
                n = len(own)
                cols = [
                    pa.array([row["part"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"], pa.int64()),
                    pa.array(row["lens"], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                ]
                names = ["part", "doc_id", "within", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([x.view(np.int32) for x in own], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    # One row for each part, as many as there are files: their sums need no more than one small window.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rows = chunks.mapInArrow(read, "part int, doc_id long, within long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))
    return rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(table(spark, sf_dir, "documents")), with_ids=False)
