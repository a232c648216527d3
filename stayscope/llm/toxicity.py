"""Toxicity by multiple-instance learning: labels of documents, scores of sentences.

A document is a bag of sentences, toxic if any of them is. A sentence's probability is logistic in
the words that it holds and in the beginnings of those words; noisy-or makes the document's of it,
1 - (1 - p1)(1 - p2)..., and the likelihood of the documents' labels is what training raises. So
sentences need no labels, and afterwards each sentence has a score of its own, which says where
a document offends.

Training takes a bounded sample of the labelled documents (``SAMPLE``, those with the least hash of their
id). One grouped count over the sample finds the words and beginnings that speak for label 1, at most the ``FEATURES``
that do so most, by the G test (``LEAST_G`` at least, as very many are tried); then each step of L-BFGS is a pass over the sample's sentences that
sums gradients in tasks and brings a row from each of ``TASKS`` to the driver. Scoring reads every text whole.

Definitions. Words are runs of ASCII letters, digits and bytes from 128 on, A-Z lower-cased; a sentence
ends at ``.``, ``!``, ``?`` or a line feed and has words, of which repeated ones count once; one of more
than ``WORDS`` words is cut into pieces. Null and empty texts, and texts without words, are one sentence without words. A document
labelled several times is toxic if any label says so; null labels and labels of no document are
ignored; of rows with one id the least text is used for training. Without labels of both kinds every
score is 0. Offsets count characters. Columns other than doc_id, text and toxic are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, work_dir
from .columns import picked
from .words import BYTE, LOWER, U, grouped, mix, text_bytes

SAMPLE = 20_000
FEATURES = 4096
LEAST_G = 20.0
THRESHOLD = 0.3
WORDS = 64
BEGINNINGS = (3, 4, 5, 6, 7, 8)
RIDGE = 0.1
STEPS = 30
TASKS = 8

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True
_WHOLE = U(0x9E3779B97F4A7C15)


class Sentences:
    """The sentences of some texts: their texts, bounds in bytes, and the words' features."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        self.raw = raw
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begin = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
        inside = _IN_WORD[raw]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        start, end = edge[0::2], edge[1::2]
        self.size = end - start
        ended = np.cumsum(_ENDS[raw])[start] if len(start) else start
        opens = np.concatenate(([True], ended[1:] != ended[:-1]))[: len(start)]
        place = np.arange(len(start)) - np.maximum.accumulate(np.where(opens, np.arange(len(start)), 0)) if len(start) else start
        opens |= place % WORDS == 0
        self.sentence = np.cumsum(opens) - 1  # of each word
        first = np.flatnonzero(opens)
        self.start = start[first]
        self.end = end[np.append(first[1:], len(start)) - 1] if len(first) else first
        self.text = np.searchsorted(self.begin, self.start, "right") - 1  # of each sentence
        data = LOWER[raw[inside]]
        self.first = np.cumsum(self.size) - self.size
        powers = mix(np.arange(1, int(self.size.max(initial=0)) + 1, dtype=U) * _WHOLE) | U(1)
        terms = BYTE[data] * powers[np.arange(len(data)) - np.repeat(self.first, self.size)]
        self.sums = np.concatenate((np.zeros(1, U), np.cumsum(terms, dtype=U)))

        self.value = mix(self.sums[self.first + self.size] - self.sums[self.first] + self.size.astype(U) + _WHOLE)

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The words and their values, then the words longer than each beginning and its values."""
        yield np.arange(len(self.size)), self.value
        at = self.sums[self.first]
        for k in BEGINNINGS:
            long = np.flatnonzero(self.size > k)
            yield long, mix(self.sums[self.first[long] + k] - at[long] + U(k))

    def characters(self, at: np.ndarray) -> np.ndarray:
        """The number of characters before the bytes ``at``, in all texts."""
        return np.concatenate(([0], np.cumsum((self.raw & 0xC0) != 0x80)))[at]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, toxic, clean): in how many texts of a batch a feature stands."""
    for batch in batches:
        y = np.array(batch.column("y").to_pylist(), bool)
        for begin, texts in grouped(text_bytes(batch)):
            found = Sentences(texts)
            pairs = [(found.text[found.sentence[w]], v) for w, v in found.features()]
            text, value = (np.concatenate(x) for x in zip(*pairs, strict=True))
            order = np.lexsort((text, value))
            text, value = text[order], value[order]
            new = np.concatenate(([True], (text[1:] != text[:-1]) | (value[1:] != value[:-1])))[: len(text)]
            value, toxic = value[new], y[begin + text[new]]
            first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))[: len(value)])
            n = np.diff(np.append(first, len(value)))
            hits = np.add.reduceat(toxic.astype(np.int64), first) if len(first) else n
            yield pa.record_batch([pa.array(value[first].view(np.int64)), pa.array(hits), pa.array(n - hits)], ["value", "toxic", "clean"])


def _sparse(batches: Iterator[pa.RecordBatch], values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(y, empty, sizes, at): of each text how many sentences have no feature, and the features of the others."""
    for batch in batches:
        labels = batch.column("y").to_pylist()
        out: list[tuple] = []
        for begin, texts in grouped(text_bytes(batch)):
            found = Sentences(texts)
            sentence, at = _known(found, values)
            n = np.bincount(found.text, minlength=len(texts))
            sizes = np.bincount(sentence, minlength=len(found.start))
            ends = np.concatenate(([0], np.cumsum(sizes)))
            bounds = np.searchsorted(found.text, np.arange(len(texts) + 1))
            for i in range(len(texts)):
                a, b = bounds[i], bounds[i + 1]
                own = sizes[a:b]
                out.append((labels[begin + i], int((own == 0).sum()) if n[i] else 1, own[own > 0].tolist(), at[ends[a] : ends[b]].tolist()))
        columns = zip(*out, strict=True) if out else [[]] * 4
        kinds = (pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["y", "empty", "sizes", "at"])


def _known(found: Sentences, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sentence and number of each feature that is among the sorted ``values``, by sentence; a repeated word counts once."""
    parts = []
    for word, value in found.features():
        at = np.minimum(np.searchsorted(values, value), len(values) - 1)
        hit = np.flatnonzero(values[at] == value)
        parts.append((word[hit], at[hit]))
    word, at = (np.concatenate(x) for x in zip(*parts, strict=True))
    sentence, value = found.sentence[word], found.value[word]
    order = np.lexsort((value, at, sentence))
    sentence, value, at = sentence[order], value[order], at[order]
    new = np.ones(len(order), bool)
    new[1:] = (sentence[1:] != sentence[:-1]) | (value[1:] != value[:-1]) | (at[1:] != at[:-1])
    return sentence[new], at[new]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def loss(bags: list[tuple[int, int, np.ndarray, np.ndarray]], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Minus the log likelihood of some bags (y, empty, sizes, at), and its gradient; the last weight is the bias."""
    y = np.array([b[0] for b in bags], float)
    empty = np.array([b[1] for b in bags], float)
    sizes = np.concatenate([np.zeros(0, np.int64), *(b[2] for b in bags)]).astype(np.int64)
    at = np.concatenate([np.zeros(0, np.int64), *(b[3] for b in bags)]).astype(np.int64)
    bag = np.repeat(np.arange(len(bags)), [len(b[2]) for b in bags])
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    bias = weights[-1]
    z = bias + np.bincount(sentence, weights[at], len(sizes))
    clean = np.bincount(bag, _softplus(z), len(bags)) + empty * _softplus(bias)  # minus log of "no sentence is toxic"
    clean = np.maximum(clean, 1e-12)
    total = np.where(y > 0, -np.log(-np.expm1(-clean)), clean).sum()
    slope = np.where(y > 0, -1 / np.expm1(np.minimum(clean, 500)), 1.0)
    p = slope[bag] / (1 + np.exp(-z))
    grad = np.bincount(at, p[sentence], len(weights))
    grad[-1] = p.sum() + (slope * empty).sum() / (1 + np.exp(-bias))
    return float(total), grad


def _losses(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    total, grad = 0.0, np.zeros(len(weights))
    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("y", "empty", "sizes", "at"))
        one, own = loss([(y, e, np.array(s, np.int64), np.array(a, np.int64)) for y, e, s, a in zip(*columns, strict=True)], weights)
        total, grad = total + one, grad + own
    yield pa.record_batch([pa.array([total]), pa.array([grad.tobytes()], pa.binary())], ["loss", "grad"])


def minimize(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """A minimum of ``f`` by L-BFGS from ``x``, with halved steps until the value falls enough."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, coefficients = -grad, []
        for s, t in reversed(past):
            a = s @ way / (s @ t)
            coefficients.append(a)
            way = way - a * t
        way = way * (past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(grad).sum()))
        for (s, t), a in zip(past, reversed(coefficients), strict=True):
            way = way + (a - t @ way / (s @ t)) * s
        size = 1.0
        while True:
            new, new_grad = f(x + size * way)
            if new <= value + 1e-4 * size * (grad @ way) or size < 1e-4:
                break
            size /= 2
        if not new < value - 1e-6 * abs(value):
            return x + size * way if new < value else x
        if (change := new_grad - grad) @ way > 0:
            past = [*past, (size * way, change)][-memory:]
        x, value, grad = x + size * way, new, new_grad
    return x


class Model:
    """Features by value, in order, with their weights and a bias."""

    def __init__(self, values: np.ndarray, weights: np.ndarray, bias: float):
        self.values, self.weights, self.bias = values, weights, bias

    def sentences(self, found: Sentences) -> np.ndarray:
        """The probability of each sentence."""
        sentence, at = _known(found, self.values)
        return 1 / (1 + np.exp(-(self.bias + np.bincount(sentence, self.weights[at], len(found.start)))))

    def documents(self, found: Sentences, p: np.ndarray, n: int) -> np.ndarray:
        """Noisy-or of the sentences of each of ``n`` texts."""
        clean = np.bincount(found.text, -np.log1p(-np.minimum(p, 1 - 1e-15)), n)
        blank = np.bincount(found.text, minlength=n) == 0
        return -np.expm1(-np.where(blank, _softplus(np.array(self.bias)), clean))


NO_MODEL = Model(np.zeros(1, U), np.zeros(1), -np.inf)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Model:
    """A model of ``labels`` (doc_id, toxic) over the texts of ``docs``."""
    spark = docs.sparkSession
    texts = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = picked(labels, "doc_id", "toxic").filter("doc_id is not null and toxic is not null")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("y"))
    known = materialize(known.join(texts, "doc_id", "left_semi"), work_dir(spark, "labels"))
    # Twice as many as needed by a bound on the hash, so that no task sorts more; then the least of these.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    some = known.filter(place < int(min(1.0, (2 * sample + 100) / max(1, known.count())) * (1 << 31)))
    some = some.orderBy(place, "doc_id").limit(sample)
    # The sample is bounded by a parameter, so it can be broadcast.
    rows = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = materialize(rows.select("y", "text"), work_dir(spark, "sample"))
    size = rows.groupBy().agg(F.count("*").alias("n"), F.sum("y").alias("toxic")).first()
    if not size["toxic"] or size["toxic"] == size["n"]:
        return NO_MODEL
    a, b = F.col("toxic") + 0.0, F.col("clean") + 0.0
    n, bad = float(size["n"]), float(size["toxic"])
    good = n - bad
    term = lambda seen, total, share: F.when(seen > 0, seen * F.log(seen / (total * share))).otherwise(0.0)
    share = (a + b) / n
    g = 2 * (term(a, bad, share) + term(b, good, share) + term(bad - a, bad, 1 - share) + term(good - b, good, 1 - share))
    counted = rows.mapInArrow(_counts, "value long, toxic long, clean long").groupBy("value").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    telling = counted.filter(a / bad > b / good).withColumn("g", g).filter(F.col("g") >= LEAST_G)
    best = telling.orderBy(F.desc("g"), "value").limit(features).select("value", "toxic", "clean").collect()
    if not best:
        return NO_MODEL
    table = np.array([tuple(r) for r in best], np.int64)
    table = table[np.argsort(table[:, 0].view(U))]
    values = np.ascontiguousarray(table[:, 0]).view(U)
    bags = rows.mapInArrow(lambda x: _sparse(x, values), "y int, empty long, sizes array<int>, at array<int>")
    bags = materialize(bags.repartition(TASKS), work_dir(spark, "bags"))

    def whole(weights: np.ndarray) -> tuple[float, np.ndarray]:
        parts = bags.mapInArrow(lambda x: _losses(x, weights), "loss double, grad binary").collect()
        total = sum(r["loss"] for r in parts) + RIDGE / 2 * weights[:-1] @ weights[:-1]
        grad = np.sum([np.frombuffer(r["grad"]) for r in parts], axis=0)
        grad[:-1] += RIDGE * weights[:-1]
        return total, grad

    odds = np.log((table[:, 1] + 0.5) / (bad + 1)) - np.log((table[:, 2] + 0.5) / (good + 1))
    weights = minimize(whole, np.append(odds / len(BEGINNINGS), -5.0), STEPS)
    return Model(values, weights[:-1], float(weights[-1]))


OFFENCE = "array<struct<from: long, to: long, score: double>>"


def _scores(batches: Iterator[pa.RecordBatch], model: Model, least: float) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64()), ("score", pa.float64())]))
    for batch in batches:
        scores: list[float] = []
        spans: list[list[dict]] = []
        for _, texts in grouped(text_bytes(batch)):
            found = Sentences(texts)
            p = model.sentences(found)
            scores += model.documents(found, p, len(texts)).tolist()
            own: list[list[dict]] = [[] for _ in texts]
            if len(bad := np.flatnonzero(p >= least)):
                text = found.text[bad]
                zero = found.characters(found.begin[text])
                start, end = found.characters(found.start[bad]) - zero, found.characters(found.end[bad]) - zero
                for t, a, b, score in zip(text.tolist(), start.tolist(), end.tolist(), p[bad].tolist(), strict=True):
                    own[t].append({"from": a, "to": b, "score": score})
            spans += own
        yield pa.record_batch([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "offences"])


def score(docs: DataFrame, model: Model, least: float = THRESHOLD) -> DataFrame:
    """doc_id, score and offences (bounds and scores of the sentences of at least ``least``), for each row of ``docs``."""
    texts = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(lambda b: _scores(b, model, least), f"doc_id long, score double, offences {OFFENCE}")
