"""Toxicity by compression distance: a window is toxic if a toxic zstandard dictionary makes it shorter than an ordinary one.

Invented or inflected words share syllables with all others, and on plain letters such chance matches
drown the rest. So text is recoded before it is compressed: a word becomes codes of CODE bytes, hashes
of its beginnings of STEMS letters and of the whole word. Equal words, and words
of one stem, compress against each other; others do not.

Two dictionaries are trained by zstandard, one on windows of toxic and one on windows of ordinary text. A training window
keeps the codes that are typical of its class: those of the TYPICAL units with the largest gain (documents times
log-odds of document frequency, SURE standard errors above zero at least). On windows of all codes training fills
dictionaries with words that both classes have, and little is told apart. The most frequent ordinary words are put
behind both. Windows of whole words, together the whole text, are
compressed with either; the difference of the lengths is the distance. How the distances of a document's
windows become a score is calibrated by logistic regression on labelled documents, each measured with
dictionaries that have not seen it.

Only the fit is bounded: at most MOST_TOXIC toxic and MOST_ORDINARY ordinary labelled documents, whole and of MOST_CHARS
characters at most, taken in the order of a hash of their ids. In the calibration each stands for as many labelled documents of its
class as there are for each one taken, so a score is a share of the corpus whatever its size. Scores are
computed for every whole text.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import by_batch, table

#: Words in a window.
WINDOW = 12
CODE = 10
STEMS = (4, 5, 7)
MOST_TOXIC = 2_000
MOST_ORDINARY = 3_000
MOST_CHARS = 1 << 18
#: Units whose codes a dictionary is trained on, and shared words. With 320 units more words that are typical by chance get in.
TYPICAL = 160
SHARED = 24
#: Bytes of a trained dictionary, and of the segments that training picks.
DICTIONARY = 16 << 10
SEGMENT = 200
#: Words whose codes a worker remembers; when full it starts anew.
REMEMBERED = 150_000
FOLDS = 4
#: Standard errors by which the log-odds of a typical word are above zero.
SURE = 3.0
THRESHOLD = 0.3
HELD_OUT = 2
#: Saved bytes from which a window counts.
STEPS = (4, 8, 16, 24)
FEATURES = 2 * len(STEPS) + 3

NOT_WORD = re.compile(r"[\W_]+")


def held_out(doc_id: Column) -> Column:
    """Whether the crc32 of the id as text leaves HELD_OUT on division by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def normal(text: str | None) -> bytes:
    return NOT_WORD.sub(" ", (text or "").lower()).strip().encode()


def units(word: bytes) -> list[bytes]:
    """What is coded of a word: its beginnings, of STEMS letters, and itself."""
    letters = word.decode()
    return [*(b"%d" % n + letters[:n].encode() for n in STEMS), b"w" + word]


def code(unit: bytes) -> bytes:
    return hashlib.blake2b(unit, digest_size=CODE).digest()


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: list[float]
    mean: list[float]
    scale: list[float]
    window: int = WINDOW

    def open(self, codes: Codes | None = None) -> Scorer:
        return Scorer(self, codes)


class Codes(dict):
    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = out = b"".join(map(code, units(word)))
        return out


class Scorer:
    def __init__(self, model: Model, codes: Codes | None = None):
        import zstandard as z

        self.model = model
        self.codes = Codes() if codes is None else codes
        self.by = []
        for content in (model.toxic, model.ordinary):
            params = z.ZstdCompressionParameters(window_log=15, hash_log=12, chain_log=12, search_log=1, min_match=6, strategy=z.STRATEGY_FAST, write_checksum=False, write_content_size=False, write_dict_id=False)
            known = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            self.by.append(z.ZstdCompressor(dict_data=known, compression_params=params).compress)

    def distances(self, text: str | None) -> np.ndarray:
        """Bytes that the toxic dictionary saves against the ordinary one, window by window."""
        toxic, ordinary = self.by
        codes = [self.codes[w] for w in normal(text).split()]
        size = self.model.window
        windows = [b"".join(codes[k : k + size]) for k in range(0, len(codes), size)]
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows], float)

    @staticmethod
    def features(d: np.ndarray) -> list[float]:
        if not len(d):
            return [0.0] * FEATURES
        counts = [int((d >= k).sum()) for k in STEPS]
        n = len(d)
        return [*map(math.log1p, counts), *(c / n for c in counts), d.max(), math.log1p(np.maximum(d, 0).sum()), math.log1p(n)]

    def score(self, text: str | None) -> float:
        return self.of(self.features(self.distances(text)))

    def of(self, features: list[float]) -> float:
        m = self.model
        z = m.weights[-1] + sum(w * (x - a) / s for w, x, a, s in zip(m.weights, features, m.mean, m.scale, strict=False))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _units_of(body: bytes) -> set[bytes]:
    return {u for w in set(body.split()) for u in units(w)}


def _often(bodies: list[bytes]) -> np.ndarray:
    """By crc32: whether a unit is in two texts at least. Rarer ones are typical of nothing and need no counter."""
    once, twice = np.zeros(1 << 23, bool), np.zeros(1 << 23, bool)
    for b in bodies:
        at = np.unique(np.fromiter(map(zlib.crc32, _units_of(b)), np.int64)) & (len(once) - 1)
        twice[at] |= once[at]
        once[at] = True
    return twice


def _frequencies(bodies: list[bytes], often: np.ndarray) -> Counter:
    """In how many of the texts each code's unit is, for units that often holds."""
    count: Counter = Counter()
    last, crc = len(often) - 1, zlib.crc32
    for b in bodies:
        count.update([u for u in _units_of(b) if often[crc(u) & last]])
    return count


def _typical(seen: list[Counter], sizes: tuple[int, int], own: int) -> set[bytes]:
    """The units typical of a class, from document frequencies in either class and how many texts either has."""
    gain = {}
    for u, n in seen[own].items():
        rest = seen[1 - own][u] + 0.5
        x = math.log((n + 0.5) / sizes[own]) - math.log(rest / sizes[1 - own])
        if x >= SURE * math.sqrt(1 / (n + 0.5) + 1 / rest):
            gain[u] = n * x
    return set(sorted(gain, key=lambda u: (-gain[u], u))[:TYPICAL])


def _trained(bodies: list[bytes], typical: set[bytes], window: int) -> bytes:
    """A dictionary that zstandard trains on the texts' windows, of which the typical codes are kept; with too little to
    train on, those codes themselves."""
    import zstandard as z

    known: dict[bytes, bytes] = {}
    samples = []
    for b in bodies:
        words = b.split()
        for w in set(words).difference(known):
            known[w] = b"".join(code(u) for u in units(w) if u in typical)
        kept = [b"".join(map(known.__getitem__, words[k : k + window])) for k in range(0, len(words), window)]
        samples += [x for x in kept if x]
    try:
        return z.train_dictionary(DICTIONARY, samples, k=SEGMENT, d=8).as_bytes()
    except z.ZstdError:
        return b"".join(dict.fromkeys(samples))[-DICTIONARY:] or b" " * 64


def _dictionaries(bodies: tuple[list[bytes], list[bytes]], seen: list[Counter], sizes: tuple[int, int], window: int) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary of texts of either class."""
    common = sorted((u for u in seen[1] if u[:1] == b"w"), key=lambda u: (-seen[1][u], u))[:SHARED]
    shared = b"".join(code(v) for u in common for v in units(u[1:]))
    toxic, ordinary = (_trained(bodies[own], _typical(seen, sizes, own), window) + shared for own in (0, 1))
    return toxic, ordinary


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Coefficients, the intercept last; weight: how many documents each row stands for, 1 on average."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * len(x) / 100 * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (weight * (p - y)) + ridge * len(x) / 100 * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(rows: list[tuple], window: int = WINDOW) -> Model:
    """A model from (text, toxic), or (text, toxic, documents that the row stands for).

    Equal texts are one text to the dictionaries; in the calibration it stands for the documents of all its rows.
    With fewer than two texts of either class every score is about the share of toxic documents.
    """
    stands: Counter = Counter()
    for t, y, *n in rows:
        stands[normal(t), int(y)] += n[0] if n else 1
    distinct = sorted(stands)
    share = (sum(n for (_, y), n in stands.items() if y) + 0.5) / (sum(stands.values()) + 1) if distinct else 1e-9
    known = Model(b" " * 64, b" " * 64, [0.0] * FEATURES + [math.log(share / (1 - share))], [0.0] * FEATURES, [1.0] * FEATURES, window)
    by = [[b for b, y in distinct if y == c] for c in (1, 0)]
    if min(map(len, by)) < 2:
        return known
    # Each fold is measured with dictionaries of the other folds; the final ones are of all rows.
    x, y, weight, codes = [], [], [], Codes()
    often = _often([b for own in by for b in own])
    parts = [[_frequencies(own[fold::FOLDS], often) for fold in range(FOLDS)] for own in by]
    total = [sum(own, Counter()) for own in parts]
    for fold in range(FOLDS):
        rest = [t - own[fold] for t, own in zip(total, parts, strict=True)]
        sizes = tuple(len(own) - len(own[fold::FOLDS]) + 1 for own in by)
        others = tuple([b for k, b in enumerate(own) if k % FOLDS != fold] for own in by)
        scorer = Model(*_dictionaries(others, rest, sizes, window), [], [], [], window).open(codes)
        for c, own in zip((1.0, 0.0), by, strict=True):
            for b in own[fold::FOLDS]:
                x.append(scorer.features(scorer.distances(b.decode())))
                y.append(c)
                weight.append(stands[b, int(c)])
    x, y, weight = np.array(x), np.array(y), np.array(weight, float) / np.mean(weight)
    mean = np.average(x, axis=0, weights=weight)
    # A feature that hardly varies here must not weigh much where it does.
    scale = np.maximum(np.sqrt(np.average((x - mean) ** 2, axis=0, weights=weight)), 0.1)
    return Model(*_dictionaries(tuple(by), total, (len(by[0]) + 1, len(by[1]) + 1), window), _logistic((x - mean) / scale, y, weight).tolist(), mean.tolist(), scale.tolist(), window)


def training_rows(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_ordinary: int = MOST_ORDINARY) -> list[tuple[str | None, int, float]]:
    """(text, toxic, stands for): up to so many labelled rows of either class, none of them held out, in the order of a hash of their ids.

    Each stands for as many labelled ids of its class, not held out, as there are for each one taken. Of rows that repeat
    an id the least text counts; texts of more than MOST_CHARS characters are not learned from.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(9))
    chosen = known.where("toxic = 1").orderBy(order, "doc_id").limit(most_toxic).unionByName(known.where("toxic <> 1").orderBy(order, "doc_id").limit(most_ordinary))
    ids = [(r.doc_id, int(r.toxic == 1)) for r in chosen.collect()]  # at most most_toxic + most_ordinary pairs of numbers
    taken = Counter(y for _, y in ids)
    every = known.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    stands = {1: every[0] / max(taken[1], 1), 0: every[1] / max(taken[0], 1)}
    of = docs.sparkSession.createDataFrame(ids, "__quire_id long, __quire_toxic int")
    short = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.length(F.coalesce("text", F.lit(""))) <= MOST_CHARS)
    texts = short.join(F.broadcast(of), F.col("doc_id") == F.col("__quire_id")).groupBy("__quire_id", "__quire_toxic").agg(F.min("text").alias("text"))
    return [(r[0], r[1], stands[r[1]]) for r in texts.select("text", "__quire_toxic").collect()]


def scored(docs: DataFrame, model: Model, name: str = "__quire_score") -> DataFrame:
    """(doc_id, score): every whole text of docs scored; a null text counts as empty."""

    def make():
        scorer = []

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            if not scorer:
                scorer.append(model.open())
            got = [scorer[0].score(t.as_py()) for t in batch.column(1)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], ["doc_id", name])

        return one

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(by_batch(make()), f"doc_id long, {name} double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most_toxic: int = MOST_TOXIC, most_ordinary: int = MOST_ORDINARY) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row for each row of docs.

    score: 0 to 1, higher for toxic. Null and empty texts have the score of no windows. Rows that repeat are
    scored each. Labels of held-out ids are not read; labels without value or id are left out, and of several
    labels of one id the highest counts. An empty table gives an empty table.
    """
    model = fit(training_rows(docs, labels, most_toxic, most_ordinary))
    out = scored(docs, model, "score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the documents predicted toxic; all columns stay, each row is judged by its own text, also if it repeats
    another or has no doc_id. Null and empty texts have the score of no windows. An empty table gives an empty table."""
    model = fit(training_rows(docs, labels))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.open()
        for texts in batches:
            yield texts.map(scorer.score)

    return docs.where(score(F.col("text").cast("string")) < threshold)
