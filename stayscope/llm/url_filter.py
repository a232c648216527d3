"""Allow and block rules for urls, held in Bloom filter cascades.

A rule is a host and the beginning of a path. Every url has a few keys, one for each of its
host's suffixes and each path length that some rule has. Over the corpus's distinct keys, its
universe, a cascade is exact: its first filter holds the listed keys, its second the keys of
the universe that pass the first without being listed, its third the listed keys that pass
the second, and so on until nothing passes wrongly. The first filter's rate of false positives
is the share of listed keys in the universe, so that every level has about as many keys as
the list, and the cascade's size follows the list and the logarithm of the corpus. Urls are
then judged without a join: a key is listed if the first level that it fails is an even one.

Definitions. The host is what stands between the first ``://`` and the next ``/``, ``?``, ``#``
or the end, with A-Z in lower case; the path goes on to ``?``, ``#`` or the end. Null urls and
urls without ``://`` have neither. A rule fits its host and all subdomains, if the path starts
with the rule's; the rule with the most characters wins, of equally long ones the one with
the longer host; a rule that is both allowed and blocked blocks. What no rule fits is allowed. Empty hosts fit no
rule. Repeated pages are judged one by one; null page_ids are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, work_dir
from .columns import any_names
from .words import U, column, mix

#: The rules of the contract's query (fixed values): verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: A cascade above this size isn't sent to the executors; its list is then joined instead.
MOST_BYTES = 64 << 20


class Filter:
    """A Bloom filter over keys that are given by two 64-bit hashes."""

    def __init__(self, n: int, rate: float, level: int):
        self.bits = max(64, int(n * np.log(1 / rate) / np.log(2) ** 2 + 63) // 64 * 64)
        self.probes = max(1, round(self.bits / max(n, 1) * np.log(2)))
        self.probes = min(self.probes, 32)
        self.level, self.words = level, np.zeros(self.bits // 64, U)

    def places(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        a = mix(h1 + U((self.level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        b = mix(h2 ^ a) | U(1)
        return (a[:, None] + np.arange(self.probes, dtype=U)[None] * b[:, None]) % U(self.bits)

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.places(h1, h2)
        return ((self.words[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1)).all(1)


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(column(batch, c).to_numpy().astype(np.int64).view(U) for c in ("h1", "h2"))


def _bits(batches: Iterator[pa.RecordBatch], level: Filter) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = np.unique(level.places(*_hashes(batch)))
        new = np.flatnonzero(np.concatenate(([True], at[1:] >> U(6) != at[:-1] >> U(6)))) if len(at) else np.zeros(0, np.int64)
        words = np.bitwise_or.reduceat(U(1) << (at & U(63)), new) if len(at) else at
        yield pa.record_batch([pa.array((at[new] >> U(6)).astype(np.int64)), pa.array(words.view(np.int64))], ["word", "bits"])


def _filled(keys: DataFrame, rate: float, level: int, n: int) -> Filter:
    """A filter of ``keys`` (h1, h2). Its words are combined before they reach the driver."""
    made = Filter(n, rate, level)
    if made.bits // 8 > MOST_BYTES:
        raise OverflowError("the filter is too large to be broadcast")
    words = keys.mapInArrow(lambda b: _bits(b, made), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    for row in words.collect():
        made.words[row["word"]] = U(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    return made


def _passing(keys: DataFrame, level: Filter) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(level.passes(*_hashes(batch))))

    return keys.mapInArrow(run, "h1 long, h2 long")


def cascade(listed: DataFrame, others: DataFrame) -> list[Filter]:
    """Filters that tell ``listed`` from ``others``, both (h1, h2), distinct, and disjoint."""
    fresh = lambda frame: materialize(frame, work_dir(listed.sparkSession, "cascade"))
    listed, others = fresh(listed), fresh(others)
    n, m = listed.count(), others.count()
    levels: list[Filter] = []
    rate = min(0.5, max(n, 1) / max(m, 1) / np.sqrt(2))
    inside, outside = listed, others
    while n:
        levels.append(_filled(inside, rate, len(levels), n))
        inside, outside = fresh(_passing(outside, levels[-1])), inside
        n, rate = inside.count(), 0.5
    return levels


def member(levels: Sequence[Filter], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether keys of the universe are listed."""
    out, left = np.zeros(len(h1), bool), np.arange(len(h1))
    for i, level in enumerate(levels):
        ok = level.passes(h1[left], h2[left])
        out[left[~ok]] = i % 2 == 1
        left = left[ok]
    out[left] = len(levels) % 2 == 1
    return out


def parsed(pages: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``row`` (``pages``), host, path and keys, an array of the hosts' suffixes with paths of the given lengths."""
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END")
    whole = pages.select(F.struct(*(pages[c] for c in pages.columns)).alias("row"), F.col("url").cast("string").alias("url"))
    split = whole.withColumn("rest", rest)
    host = F.regexp_extract("rest", r"^[^/?#]*", 0)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = split.withColumn("host", F.coalesce(host, F.lit("")))
    path = F.regexp_extract("rest", r"(?s)^[^/?#]*([^?#]*)", 1)
    split = split.withColumn("path", F.coalesce(path, F.lit("")))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    sizes = F.array(*(F.lit(n) for n in sorted(set(lengths)))) if lengths else F.array().cast("array<int>")
    sizes = F.filter(sizes, lambda n: n <= F.length("path"))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(sizes, lambda n: F.struct(s.alias("host"), F.col("path").substr(F.lit(1), n).alias("path")))))
    keys = F.when(F.col("host") != "", keys).otherwise(F.slice(keys, 1, 0))
    return split.select("row", "host", "path", keys.alias("keys"))


def _hash(host, path) -> list:
    return [F.xxhash64(host, path).alias("h1"), F.xxhash64(F.lit(7), host, path).alias("h2")]


def _judged(batches: Iterator[pa.RecordBatch], lists: dict[str, list[Filter]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = column(batch, "keys")
        flat, ends = keys.flatten(), np.cumsum([0, *keys.value_lengths().fill_null(0).to_pylist()])
        hosts, paths = flat.field("host").to_pylist(), flat.field("path").to_pylist()
        h1, h2 = (flat.field(c).to_numpy().astype(np.int64).view(U) for c in ("h1", "h2"))
        found = {verdict: member(levels, h1, h2) for verdict, levels in lists.items()}
        rules, verdicts = [], []
        for a, b in zip(ends, ends[1:], strict=False):
            fits = [(len(hosts[i]) + len(paths[i]), len(hosts[i]), v, hosts[i] + paths[i]) for i in range(a, b) for v, x in found.items() if x[i]]
            best = max(fits, default=None)
            rules.append(best and best[3])
            verdicts.append(best[2] if best else "allow")
        names = ["row", "host", "path"]
        yield pa.record_batch([*(column(batch, n) for n in names), pa.array(rules, pa.string()), pa.array(verdicts)], [*names, "rule", "verdict"])


def _by_join(split: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for lists that are too long for a filter that is sent to every executor."""
    # Written down, as the numbers are used twice.
    rows = materialize(split.withColumn("id", F.monotonically_increasing_id()), work_dir(split.sparkSession, "urls"))
    keys = rows.select("id", F.explode("keys").alias("key")).select("id", "key.host", "key.path")
    fit = keys.join(rules, ["host", "path"]).select("id", F.struct(F.length(F.concat("host", "path")), F.length("host"), "verdict", F.concat("host", "path").alias("rule")).alias("fit"))
    best = fit.groupBy("id").agg(F.max("fit").alias("fit"))
    return rows.join(best, "id", "left").select("row", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.lit("allow")).alias("verdict"))


@any_names("page_id", "url", "html")
def filter_urls(pages: DataFrame, rules: DataFrame | Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``row`` (``pages``), host, path, rule, verdict: one row for each page. rules: verdict, host, path."""
    spark: SparkSession = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    lengths = [r["n"] for r in rules.select(F.length("path").alias("n")).distinct().collect()]  # as many as there are lengths of a path
    split = parsed(pages, lengths)
    hashed = F.transform("keys", lambda x: F.struct(x["host"].alias("host"), x["path"].alias("path"), *_hash(x["host"], x["path"])))
    split = split.withColumn("keys", hashed)
    seen = split.select(F.explode("keys").alias("key")).select("key.h1", "key.h2").distinct()
    universe = materialize(seen, work_dir(spark, "universe"))
    lists = {}
    try:
        for verdict in ("allow", "block"):
            listed = rules.filter(F.col("verdict") == verdict).select(*_hash(F.col("host"), F.col("path"))).distinct()
            lists[verdict] = cascade(listed, universe.join(listed, ["h1", "h2"], "left_anti"))
    except OverflowError:
        return _by_join(split, rules)
    kind = split.schema["row"].dataType.simpleString()
    return split.mapInArrow(lambda b: _judged(b, lists), f"row {kind}, host string, path string, rule string, verdict string")
