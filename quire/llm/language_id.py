"""Language identification with a linear-chain conditional random field over words.

Every word of a text has one label, a language. Its emission score sums weights of hashed features:
n-grams of its bytes (2 to 4), affixes (the n-grams that touch a word's start or end, which carry a mark
there) and the word itself (the lexicon). Scores of neighbouring labels are learned transitions.
Forward-backward gives each word's label probabilities, also where a text switches languages. A document
has the language of the largest expected share of its words, to which the share among its first OPENING
words is added with a weight that is learned too (labels of code-switched documents may go by how they begin).

Training maximises the conditional likelihood of label sequences by stochastic gradients. Labels of
documents are turned into labels of words, and sequences are built from runs of words of different
documents, so that transitions are learned from code-switched text. Only the fit is bounded: at most
MOST_ROWS labelled rows of each language, whole and of MOST_CHARS characters at most, taken in the order of a hash of
their ids and texts. Every language that labels name is learned; weights and time grow with their number.

Everything that is done for each byte or word is one numpy operation over a batch of documents.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import by_batch, table

MOST_ROWS = 300
MOST_CHARS = 1 << 18
BITS = 16
ORDERS = (2, 3, 4)
#: Training: words in a sequence, words in a run of one document, passes, step size, ridge.
SEQUENCE = 96
RUN = (8, 64)
PASSES = 3
STEP = 0.35
RIDGE = 1e-7
#: Words at which sequences are put together for a step.
BATCH_WORDS = 24_000
OPENING = 5
OPENING_WEIGHTS = (0.0, 0.1, 0.25, 0.5, 1.0, 2.0)
#: Characters of text that are labelled at a time.
PIECE = 2 << 20
HELD_OUT = 2
UNKNOWN = "und"



NOT_LETTER = re.compile(r"[\W\d_]+")
#: What else \w has beside letters (Unicode category L): numbers such as one half or Roman numerals, by their code points.
NUMBERS = {ord(c): " " for c in map(chr, range(128, sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha() and not c.isdecimal()}
NUMBER_SIGNS = frozenset(map(chr, NUMBERS))
MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Whether the crc32 of the id as text leaves HELD_OUT on division by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def letters(text: str | None) -> bytes:
    """The text's words: runs of letters, lower case, in UTF-8, with one space between."""
    body = (text or "").lower()
    if not body.isascii() and not NUMBER_SIGNS.isdisjoint(body):
        body = body.translate(NUMBERS)
    return NOT_LETTER.sub(" ", body).strip().encode()


@dataclass
class Words:
    """Features of the words of some texts: indices into the table of weights, word by word."""

    index: np.ndarray  # (bytes, orders): 0 where there is no n-gram
    starts: np.ndarray  # first byte of each word
    lexicon: np.ndarray  # index of the word itself
    sizes: np.ndarray  # words of each text


def words_of(bodies: list[bytes]) -> Words:
    sizes = np.array([b.count(b" ") + 1 if b else 0 for b in bodies], np.int64)
    buf = np.frombuffer(b" " + b" ".join(b for b in bodies if b) + b" " * 4, np.uint8)
    n = len(buf) - 4
    space = buf == 32
    gap = np.concatenate([[0], np.cumsum(space)])
    index = np.zeros((n, len(ORDERS)), np.int32)
    wide = np.zeros(n, np.uint32)
    for k in range(max(ORDERS)):
        wide |= buf[k : k + n].astype(np.uint32) << np.uint32(8 * k)
        if k + 1 in ORDERS:
            # A gram belongs to a word if no space is inside it: at its first or last byte it marks an affix.
            inner = gap[k : n + k] - gap[1 : n + 1] if k else np.zeros(n, int)
            last = space[k : k + n]
            ok = (inner == 0) & ~(space[:n] & last)
            g = wide.astype(np.uint64) + (np.uint64(k + 1) << np.uint64(40))
            g = (g * MIX) >> np.uint64(64 - BITS)
            index[:, ORDERS.index(k + 1)] = np.where(ok, g.astype(np.int32) + 1, 0)
    starts = np.flatnonzero(~space[1:n] & space[: n - 1]) if n else np.zeros(0, int)  # each run starts at the space before its word
    if len(starts):
        word = np.cumsum(np.isin(np.arange(n), starts)) - 1
        at = np.arange(n) - starts[np.maximum(word, 0)]
        power = (np.arange(1, 65, dtype=np.uint64) * MIX) | np.uint64(1)
        part = (buf[:n].astype(np.uint64) + np.uint64(1)) * power[at % 64]
        part[space[:n]] = 0
        whole = np.add.reduceat(part, starts)
        whole ^= whole >> np.uint64(31)
        lexicon = ((whole * MIX) >> np.uint64(64 - BITS)).astype(np.int32) + 1 + (1 << BITS)
    else:
        lexicon = np.zeros(0, np.int32)
    return Words(index, starts, lexicon, sizes)


def emissions(w: Words, weights: np.ndarray) -> np.ndarray:
    """(words, labels) scores."""
    if not len(w.starts):
        return np.zeros((0, weights.shape[1]), np.float32)
    out = np.empty((len(w.starts), weights.shape[1]), np.float32)
    for label in range(weights.shape[1]):
        column = weights[:, label]
        score = column[w.index[:, 0]]
        for k in range(1, len(ORDERS)):
            score = score + column[w.index[:, k]]
        out[:, label] = np.add.reduceat(score, w.starts) + column[w.lexicon]
    return out


def forward_backward(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probabilities (words, labels), expected transitions (labels, labels), expected first labels) of chains laid end to end.

    Chains are walked side by side, longest first, so that a step is one operation over all that still run.
    """
    n_labels = scores.shape[1]
    sizes = sizes[sizes > 0]
    if not len(sizes):
        return np.zeros((0, n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    base = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    size, base = sizes[order], base[order]
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64) + 1e-30
    go = np.exp(transitions - transitions.max())
    forward, backward = np.empty_like(e), np.ones_like(e)
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")  # chains with a word at each step
    a = e[base] * np.exp(start - start.max())
    a /= a.sum(axis=1, keepdims=True)
    forward[base] = a
    for t in range(1, int(size[0])):
        k = live[t]
        at = base[:k] + t
        a = (a[:k] @ go) * e[at]
        a /= a.sum(axis=1, keepdims=True)
        forward[at] = a
    b = np.ones((0, n_labels))
    for t in range(int(size[0]) - 2, -1, -1):
        k, before = live[t + 1], len(b)
        if k > before:
            b = np.concatenate([b, np.ones((k - before, n_labels))])
        at = base[:k] + t
        b = (b * e[at + 1]) @ go.T
        b /= b.sum(axis=1, keepdims=True)
        backward[at] = b
    p = forward * backward
    p /= p.sum(axis=1, keepdims=True)
    first = p[base].sum(axis=0)
    inner = np.ones(len(e), bool)
    inner[base] = False
    to = np.flatnonzero(inner)
    pair = None
    if len(to):
        right = e[to] * backward[to]
        norm = np.einsum("ni,ij,nj->n", forward[to - 1], go, right)
        pair = go * (forward[to - 1].T @ (right / norm[:, None]))
    return p, pair if pair is not None else np.zeros((n_labels, n_labels)), first


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    opening: float = 0.0

    def label(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities of all words, words of each text)."""
        w = words_of([letters(t) for t in texts])
        p, _, _ = forward_backward(emissions(w, self.weights), w.sizes, self.transitions, self.start)
        return p, w.sizes

    def both_shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages): the expected share of each language in a text's words, and in its first ones; zero without words."""
        p, sizes = self.label(texts)
        out = np.zeros((2, len(texts), len(self.languages)))
        own = sizes > 0
        if own.any():
            n = sizes[own]
            base = (np.cumsum(sizes) - sizes)[own]
            out[0, own] = np.add.reduceat(p, base, axis=0) / n[:, None]
            first = np.minimum(n, OPENING)
            run = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p, axis=0)])
            out[1, own] = (run[base + first] - run[base]) / first[:, None]
        return out[0], out[1]

    def shares(self, texts: list[str | None]) -> np.ndarray:
        """(texts, languages): what a document's language is decided by; each row with words sums to one."""
        every, first = self.both_shares(texts)
        return (every + self.opening * first) / (1 + self.opening)


def fit(rows: list[tuple[str | None, str]], seed: int = 7) -> Model:
    """A model from (text, language) rows; repeats of a text count once for each language."""
    languages = sorted({y for _, y in rows})
    rng = np.random.default_rng(seed)
    number = {y: k for k, y in enumerate(languages)}
    runs: list[tuple[list[bytes], int]] = []
    for text, y in sorted({(letters(t), y) for t, y in rows}):
        words, at = text.split(), 0
        while at < len(words):
            n = int(rng.integers(*RUN))
            runs.append((words[at : at + n], number[y]))
            at += n
    n_labels = len(languages)
    weights = np.zeros(((1 << (BITS + 1)) + 1, n_labels), np.float32)
    transitions, start = np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    squares = [np.full(x.shape, 1e-3, np.float32) for x in (weights, transitions, start)]
    if n_labels < 2:
        return Model(languages, weights, transitions, start)
    # Languages have as many runs as the one with most, by repetition.
    by = [[r for r in runs if r[1] == k] for k in range(n_labels)]
    most = max(map(len, by))
    balanced = [own[i % len(own)] for own in by if own for i in range(min(most, 4 * len(own)))]
    for _ in range(PASSES):
        order = rng.permutation(len(balanced))
        flat = [(w, y) for k in order for w in balanced[k][0] for y in (balanced[k][1],)]
        for at in range(0, len(flat), BATCH_WORDS):
            part = flat[at : at + BATCH_WORDS]
            bodies = [b" ".join(w for w, _ in part[k : k + SEQUENCE]) for k in range(0, len(part), SEQUENCE)]
            y = np.array([label for _, label in part])
            w = words_of(bodies)
            p, pair, first = forward_backward(emissions(w, weights), w.sizes, transitions, start)
            base = np.cumsum(w.sizes) - w.sizes
            delta = p.copy()
            delta[np.arange(len(y)), y] -= 1
            inner = np.ones(len(y), bool)
            inner[base] = False
            to = np.flatnonzero(inner)
            np.subtract.at(pair, (y[to - 1], y[to]), 1)
            np.subtract.at(first, y[base], 1)
            word = np.repeat(np.arange(len(w.starts)), np.diff(np.append(w.starts, len(w.index))))
            skip = len(w.index) - len(word)
            grad = np.empty_like(weights)
            for label in range(n_labels):
                of_byte = delta[word, label]
                g = np.bincount(w.lexicon, delta[:, label], len(weights))
                for k in range(len(ORDERS)):
                    g += np.bincount(w.index[skip:, k], of_byte, len(weights))
                grad[:, label] = g
            grad[0] = 0
            for x, g, s in zip((weights, transitions, start), (grad + RIDGE * len(y) * weights, pair, first), squares, strict=True):
                g = g / len(bodies)
                s += g * g
                x -= (STEP * g / np.sqrt(s)).astype(x.dtype)
    model = Model(languages, weights, transitions, start)
    texts = [t for t, _ in rows]
    parts = [model.both_shares(texts[a:b]) for a, b in _pieces(texts)]
    every, first = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
    y = np.array([number[y] for _, y in rows])
    right = [((every + o * first).argmax(axis=1) == y).sum() for o in OPENING_WEIGHTS]
    model.opening = OPENING_WEIGHTS[int(np.argmax(right))]
    return model


def training_rows(docs: DataFrame, most_rows: int = MOST_ROWS) -> list[tuple[str | None, str]]:
    """Up to most_rows rows of each language, none held out, in the order of a hash of their ids and texts; equal rows count once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    rows = rows.where("doc_id is not null and lang is not null").where(~held_out(F.col("doc_id"))).where(F.length("text") <= MOST_CHARS)
    keys = rows.select("lang", F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(5)), 1).alias("draw"), "doc_id", F.xxhash64("text").alias("of"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row for each language

    def least(of: DataFrame) -> list:
        order = Window.partitionBy("lang").orderBy("draw", "doc_id", "of")
        return of.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= most_rows).select("doc_id", "lang", "of").collect()

    # Draws under a bound that some three times most_rows rows meet, so that a language of most rows isn't ordered in one task;
    # languages in which they were too few, as when rows repeat ids, are ordered as they are.
    bounds = [(y, min(1.0, 3 * (most_rows + 50) / n) * float(1 << 63)) for y, n in counts.items()]
    bounded = docs.sparkSession.createDataFrame(bounds, "lang string, bound double") if bounds else None
    chosen = least(keys.join(F.broadcast(bounded), "lang").where("draw <= bound").drop("bound")) if bounds else []
    got = Counter(r.lang for r in chosen)
    scarce = [y for y, bound in bounds if got[y] < most_rows and bound < 1 << 63]
    if scarce:
        chosen = [r for r in chosen if r.lang not in scarce] + least(keys.where(F.col("lang").isin(scarce)))
    known = docs.sparkSession.createDataFrame(chosen, "__quire_id long, __quire_lang string, __quire_of long")
    same = (F.col("doc_id") == F.col("__quire_id")) & (F.col("lang") == F.col("__quire_lang")) & (F.xxhash64("text") == F.col("__quire_of"))
    found = rows.join(F.broadcast(known), same).select("doc_id", "lang", "text").distinct()
    return [(r.text, r.lang) for r in found.collect()]


def _pieces(texts: list[str | None], most: int = PIECE):
    at = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, shares map<string,double>), one row for each row of docs.

    score is the share of the predicted language. Null texts and texts without a letter are 'und' with score
    0, as is every text if the model knows no language. Rows that repeat are labelled each; an empty table gives
    an empty table; other columns than doc_id and text are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = sent.value
        texts = batch.column(1).to_pylist()
        shares = np.concatenate([m.shares(texts[a:b]) for a, b in _pieces(texts)]) if m.languages else np.zeros((len(texts), 1))
        names = np.array([*m.languages] or [UNKNOWN], object)
        best = shares.argmax(axis=1)
        score = np.minimum(shares[np.arange(len(texts)), best], 1.0)
        pred = np.where(score > 0, names[best], UNKNOWN)
        maps = [[(n, float(x)) for n, x in zip(names, row, strict=True)] if s else [] for row, s in zip(shares, score, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(pred, pa.string()), pa.array(score), pa.array(maps, pa.map_(pa.string(), pa.float64()))], ["doc_id", "lang_pred", "score", "shares"]
        )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(by_batch(one), "doc_id long, lang_pred string, score double, shares map<string,double>")


def switches(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, runs array<struct<first,last,lang>>): maximal runs of words (letter runs, counted from 0) with one most likely language."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        m, out = sent.value, []
        texts = batch.column(1).to_pylist()
        for a, b in _pieces(texts):
            p, sizes = m.label(texts[a:b])
            best, at = p.argmax(axis=1), 0
            for n in sizes.tolist():
                own = best[at : at + n]
                cut = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), n] if n else [0]
                out.append([{"first": x, "last": y - 1, "lang": m.languages[own[x]]} for x, y in zip(cut, cut[1:], strict=False)])
                at += n
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "runs"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(by_batch(one), "doc_id long, runs array<struct<first:int,last:int,lang:string>>")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, fit(training_rows(docs)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
