"""Document quality by hierarchical empirical Bayes.

A logistic model of the text, fitted on labelled documents, gives each document's evidence: its log
likelihood ratio of good against bad. It has a few features of the text's shape, and one of its content: the
words that tell good from bad by the G test, at most ``WORDS`` of them, counted over the labelled documents by
one grouped aggregation, each with its log odds. While the model is fitted, a document's words have the log
odds that the other half of the documents gives them, so that no document speaks for itself. Posteriors are then
pooled by grouped aggregation: the corpus gives a global prior, each host (``source``) a
rate shrunk to the global one, and each path in it (``lang``) a rate shrunk to its host's. How
much a level is shrunk follows from the spread of its groups beyond what sampling explains
(method of moments for a beta prior), so sparse groups lean on their parents and large ones
stand on their own. A document's score adds the log odds of its path to its evidence.

Definitions. Null and empty texts have the features of a text without words. Null hosts
and paths are groups of their own. Labels that are null or name no document are ignored; a
document is used once however often it is labelled or repeated, with its worst label and least text.
Without labels of both kinds the evidence is 0 and every document is kept. At most ``SAMPLE``
labelled documents of the table are fitted, those with the least hash of their id; all else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, work_dir
from .columns import any_names
from .words import U, Words, column, grouped, text_bytes
from .workers import forget_others

SAMPLE = 20_000
THRESHOLD = 0.5
#: Features of a text's shape, and all of them.
SHAPE, FEATURES = 12, 13
#: Words whose log odds are kept, and the G value that they need.
WORDS, LEAST_G = 4096, 20.0

_KIND = np.zeros(256, np.int8)  # 1 lower case or not ASCII, 2 upper case, 3 digit, 4 sentence mark, 5 other sign
_KIND[[*range(97, 123), *range(128, 256)]] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[ord(c) for c in ".,;:?'\"-()"]] = 4
_KIND[[b for b in range(33, 127) if not _KIND[b]]] = 5


class Content:
    """The log odds of some words, by value in order."""

    def __init__(self, values: np.ndarray, odds: np.ndarray):
        self.values, self.odds = values, odds

    def total(self, text: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """For each of ``n`` texts the sum over its different words (text, value), by the root of their number."""
        if not len(self.values):
            return np.zeros(n)
        at = np.minimum(np.searchsorted(self.values, value), len(self.values) - 1)
        odds = np.where(self.values[at] == value, self.odds[at], 0.0)
        return np.bincount(text, odds, n) / np.sqrt(np.maximum(np.bincount(text, minlength=n), 1))


NO_CONTENT = Content(np.zeros(0, U), np.zeros(0))


def described(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of ``SHAPE`` numbers for each text, and the different words of the texts, as text and value."""
    words = Words(texts)
    n = np.diff(words.bounds)
    out = np.zeros((len(texts), SHAPE))
    if not len(words.start):
        return out, np.zeros(0, np.int64), words.value
    size = words.end - words.start
    shares = np.stack([np.add.reduceat(np.append(_KIND[words.data] == kind, False), np.stack((words.start, words.end), 1).ravel())[::2] for kind in range(1, 6)], 1) / size[:, None]
    last = _KIND[words.data[words.end - 1]]
    text = np.repeat(np.arange(len(texts)), n)
    same = np.zeros(len(size), bool)
    same[1:] = (words.value[1:] == words.value[:-1]) & (text[1:] == text[:-1])
    order = np.lexsort((words.value, text))
    new = np.concatenate(([True], (words.value[order][1:] != words.value[order][:-1]) | (text[order][1:] != text[order][:-1])))
    mean = lambda x: np.bincount(text, x, len(texts)) / np.maximum(n, 1)
    out[:, 0] = np.log1p(n)
    out[:, 1] = np.log1p(mean(size))
    out[:, 2:7] = np.stack([mean(shares[:, j]) for j in range(5)], 1)
    out[:, 7] = mean(last == 5)
    out[:, 8] = mean((shares[:, 1] > 0.6) & (size > 1))
    out[:, 9] = mean(shares[:, 4] == 1)
    out[:, 10] = mean(same)
    distinct = np.bincount(text[order], new, len(texts))
    out[:, 11] = np.log1p(distinct) - np.log1p(n)
    return out, text[order][new], words.value[order][new]


def features(texts: list[bytes], content: Content) -> np.ndarray:
    """A row of ``FEATURES`` numbers for each text."""
    shape, text, value = described(texts)
    return np.column_stack((shape, content.total(text, value, len(texts))))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, half, good, bad): how many texts of a half have a word."""
    forget_others("quality")
    for batch in batches:
        y, half = (np.array(column(batch, c).to_pylist(), np.int64) for c in ("y", "half"))
        for begin, texts in grouped(text_bytes(batch)):
            _, text, value = described(texts)
            kind = 2 * half[begin + text] + y[begin + text]
            values, at = np.unique(value, return_inverse=True)
            seen = np.bincount(4 * at + kind, minlength=4 * len(values)).reshape(-1, 2, 2)
            rows, halves = np.nonzero(seen.sum(2))
            counts = seen[rows, halves]
            yield pa.record_batch(
                [pa.array(values[rows].view(np.int64)), pa.array(halves.astype(np.int32)), pa.array(counts[:, 1]), pa.array(counts[:, 0])],
                ["value", "half", "good", "bad"],
            )


def _content(counted: DataFrame, good: int, bad: int) -> Content:
    """The words that tell most, from (value, good, bad) over so many good and bad documents."""
    if not good or not bad:
        return NO_CONTENT
    a, b, n = F.col("good") + 0.0, F.col("bad") + 0.0, float(good + bad)
    share = (a + b) / n
    term = lambda seen, total, share: F.when(seen > 0, seen * F.log(seen / (total * share))).otherwise(0.0)
    g = 2 * (term(a, good, share) + term(b, bad, share) + term(good - a, good, 1 - share) + term(bad - b, bad, 1 - share))
    best = counted.withColumn("g", g).filter(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "value").limit(WORDS)
    table = np.array([tuple(r) for r in best.select("value", "good", "bad").collect()], np.int64).reshape(-1, 3)
    table = table[np.argsort(table[:, 0].view(U))]
    odds = np.log((table[:, 1] + 0.5) / (good + 1)) - np.log((table[:, 2] + 0.5) / (bad + 1))
    return Content(np.ascontiguousarray(table[:, 0]).view(U), odds)


def _feature_rows(batches: Iterator[pa.RecordBatch], contents: list[Content]) -> Iterator[pa.RecordBatch]:
    """Each document's features with the content of the other half."""
    for batch in batches:
        half = np.array(column(batch, "half").to_pylist(), np.int64)
        rows = []
        for begin, texts in grouped(text_bytes(batch)):
            shape, text, value = described(texts)
            total = np.stack([c.total(text, value, len(texts)) for c in contents], 1)
            own = half[begin : begin + len(texts)]
            rows.append(np.column_stack((shape, total[np.arange(len(texts)), 1 - own])))
        flat = np.concatenate(rows) if rows else np.zeros((0, FEATURES))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * FEATURES), pa.array(flat.ravel()))
        yield pa.record_batch([column(batch, "doc_id"), column(batch, "y"), lists], ["doc_id", "y", "x"])


class Model:
    """Logistic weights on standardised features; ``ratio`` is free of the sample's prior."""

    def __init__(self, x: np.ndarray, y: np.ndarray, content: Content = NO_CONTENT):
        self.content = content
        self.mean = x.mean(0) if len(x) else np.zeros(FEATURES)
        self.scale = np.maximum(x.std(0), 1e-6) if len(x) else np.ones(FEATURES)
        self.weight, self.bias = np.zeros(FEATURES), 0.0
        if len(np.unique(y)) < 2:
            return
        z = np.column_stack((np.clip((x - self.mean) / self.scale, -8, 8), np.ones(len(x))))
        w, ridge = np.zeros(FEATURES + 1), np.append(np.ones(FEATURES), 0)
        for _ in range(50):  # Newton steps; ridge keeps separable classes finite
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            grad = z.T @ (y - p) - ridge * w
            hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9)
            step = np.linalg.solve(hess, grad)
            w += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        prior = np.log(y.mean() / (1 - y.mean()))
        self.weight, self.bias = w[:-1], w[-1] - prior

    def ratio(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight + self.bias


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of ``labels`` (doc_id, quality) over the texts of ``docs``."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = known.agg(F.min(F.col("quality").cast("int")).alias("y")).join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    known = materialize(known, work_dir(docs.sparkSession, "labels"))
    # Twice as many as needed by a bound on the hash, so that no task sorts more; then the least of these.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    share = min(1.0, (2 * sample + 100) / max(1, known.count()))
    known = known.filter(place < int(share * (1 << 31))).orderBy(place, "doc_id").limit(sample)
    # The sample is bounded by a parameter, so it can be broadcast.
    rows = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    half = (F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2))).cast("int").alias("half")
    rows = materialize(rows.select("doc_id", (F.col("y") > 0).cast("int").alias("y"), "text", half), work_dir(docs.sparkSession, "sample"))
    sizes = {(r["half"], r["y"]): r["n"] for r in rows.groupBy("half", "y").agg(F.count("*").alias("n")).collect()}
    counted = rows.mapInArrow(_word_counts, "value long, half int, good long, bad long").groupBy("value", "half")
    counted = materialize(counted.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), work_dir(docs.sparkSession, "words"))
    contents = [_content(counted.filter(F.col("half") == h), sizes.get((h, 1), 0), sizes.get((h, 0), 0)) for h in (0, 1)]
    both = counted.groupBy("value").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    content = _content(both, *(sizes.get((0, y), 0) + sizes.get((1, y), 0) for y in (1, 0)))
    got = rows.mapInArrow(lambda b: _feature_rows(b, contents), "doc_id long, y int, x array<double>").orderBy("doc_id").collect()
    x = np.array([r["x"] for r in got]).reshape(-1, FEATURES)
    return Model(x, np.array([r["y"] for r in got], float), content)


def _evidence(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    forget_others("quality")
    for batch in batches:
        texts = text_bytes(batch) if "text" in batch.schema.names else column(batch, "row").field("text").cast(pa.binary()).to_pylist()
        rows = [model.ratio(features(some, model.content)) for _, some in grouped(texts)]
        ratio = np.concatenate(rows) if rows else np.zeros(0)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.record_batch([*(column(batch, n) for n in names), pa.array(ratio)], [*names, "evidence"])


def _strength(groups: DataFrame, parent: Column) -> float:
    """The weight of the parent's rate, in documents, by the spread of the groups around it."""
    rate = F.col("s") / F.col("n")
    spread = F.sum(F.col("n") * (rate - parent) ** 2).alias("spread")
    noise = F.sum(parent * (1 - parent)).alias("noise")
    total = groups.agg(spread, noise, F.sum("n").alias("n"), F.sum(F.col("n") * parent * (1 - parent)).alias("level")).first()
    if not total["n"]:
        return 1.0
    between = max((total["spread"] - total["noise"]) / total["n"], 1e-6)
    return max(1.0, total["level"] / total["n"] / between - 1)


def _log_odds(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def sites(pooled: DataFrame) -> DataFrame:
    """(host, path, rate): shrunk rates from ``pooled`` (host, path, n, s), counts and sums of posteriors."""
    total = pooled.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    overall = (total["s"] + 0.5) / (total["n"] + 1) if total["n"] else 0.5
    hosts = pooled.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    k = _strength(hosts, F.lit(overall))
    hosts = hosts.select("host", ((F.col("s") + k * overall) / (F.col("n") + k)).alias("host_rate")).alias("h")
    paths = pooled.alias("p").join(hosts, F.col("p.host").eqNullSafe(F.col("h.host"))).select("p.*", "host_rate")
    k = _strength(paths, F.col("host_rate"))
    return paths.select("host", "path", ((F.col("s") + k * F.col("host_rate")) / (F.col("n") + k)).alias("rate"))


@any_names("doc_id", "text", "lang", "source", "n_chars")
def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE, labelled: DataFrame | None = None) -> DataFrame:
    """``row`` (``docs``), evidence, site_rate, score, keep: one row for each document.

    labelled: the documents that the labels are about, if not ``docs``.
    """
    model = fit(docs if labelled is None else labelled, labels, sample)
    site = [F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path")]
    text = F.col("text").cast("string").alias("text")
    brief = docs.select(*site, text).mapInArrow(lambda b: _evidence(b, model), "host string, path string, evidence double")
    posterior = 1 / (1 + F.exp(-F.col("evidence")))
    folder = lambda: work_dir(docs.sparkSession, "quality")
    pooled = materialize(brief.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(posterior).alias("s")), folder())
    rates = materialize(sites(pooled), folder())
    whole = docs.withColumn("text", text).select(F.struct(*docs.columns).alias("row"), *site)
    kind = whole.schema["row"].dataType.simpleString()
    scored = whole.mapInArrow(lambda b: _evidence(b, model), f"row {kind}, host string, path string, evidence double").alias("d")
    same = F.col("d.host").eqNullSafe(F.col("r.host")) & F.col("d.path").eqNullSafe(F.col("r.path"))
    joined = scored.join(rates.alias("r"), same, "left").select("d.row", "d.evidence", F.col("r.rate").alias("site_rate"))
    moved = _log_odds(F.coalesce("site_rate", F.lit(0.5)))
    score = 1 / (1 + F.exp(-(F.col("evidence") + moved)))
    return joined.withColumn("score", score).withColumn("keep", F.col("score") >= THRESHOLD)
