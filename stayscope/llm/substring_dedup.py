"""Removal of word passages that occur more than once, found by recompression.

Words are symbols. A round names every run of a symbol and then every pair (a, b) whose
first symbol is on the left and whose second is on the right side of the round's partition
of all symbols. A name is a 64-bit value of what it stands for, so it is the same in every
document and task without being looked up, and the partition is a bit of the name. Whether
a symbol appears depends only on a stretch of words around it, its context, whose bounds
are carried along. So wherever a window of words occurs, it holds the same symbols with a
context inside it; the least of those of the highest round is the window's anchor, and
equal windows have equal anchors at equal places.

Spark then counts the anchors. Windows whose anchor occurs once are unique. The others are
compared exactly, by a second value of all their words, among the windows of their anchor,
in one shuffle by anchor. The windows of frequent anchors are dealt by document to shares of
bounded size. Each share hands on its different windows, as lists by a part of their values, and
learns which of them other shares have too. Documents with the same words throughout are
all repeated, and only one of them takes part in the comparison.

Definitions. A window is ``WINDOW`` consecutive words of one document; it is repeated if
its words also start elsewhere, overlapping places in the same document included. Every
word in a repeated window goes. Null text has no words, shorter texts have no windows. A
null doc_id is a document like any other; repeated rows are separate documents. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, work_dir
from .columns import any_names
from .words import U, Words, column, grouped, mix, sequence_hash, text_bytes

WINDOW = 35
ROUNDS = 7
#: Rounds that name runs, before they name pairs.
RUN_ROUNDS = (0, 3)
#: Occurrences of an anchor in one share, about.
FREQUENT = 2000
FOUND = "found array<struct<first: int, mask: long>>"
#: Bits of a packed value that hold the symbol's place.
PLACE = U((1 << 24) - 1)


class Level:
    """Symbols in text order with the bounds of their contexts."""

    def __init__(self, name: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.name, self.lo, self.hi = name, lo, hi

    def runs(self, seed: int) -> Level:
        name, n = self.name, len(self.name)
        first = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
        size = np.diff(np.append(first, n))
        named = np.where(size > 1, mix(mix(name[first] + U(seed)) + size.astype(U)), name[first])
        last = first + size - 1
        return Level(named, self.lo[np.maximum(first - 1, 0)], self.hi[np.minimum(last + 1, n - 1)])

    def pairs(self, seed: int) -> Level:
        name, n = self.name, len(self.name)
        left = (mix(name + U(seed)) & U(1)).astype(bool)
        joins = np.zeros(n, bool)
        joins[:-1] = left[:-1] & ~left[1:]
        taken = np.zeros(n, bool)
        taken[1:] = joins[:-1]
        near = np.arange(n)
        far = np.where(left, np.minimum(near + 1, n - 1), near)
        back = np.where(left, near, np.maximum(near - 1, 0))
        back[joins] = near[joins]
        named = name.copy()
        at = np.flatnonzero(joins)
        named[at] = mix(mix(name[at] + U(seed)) * U(3) + name[at + 1])
        keep = np.flatnonzero(~taken)
        return Level(named[keep], self.lo[back[keep]], self.hi[far[keep]])


def levels(value: np.ndarray) -> list[Level]:
    """The symbols of every round; the first level is the words themselves."""
    place = np.arange(len(value))
    found = [Level(value, place, place + 1)]
    for r in range(ROUNDS):
        seed = (r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        level = found[-1].runs(seed) if r in RUN_ROUNDS else found[-1]
        found.append(level.pairs(seed ^ 0xABCDEF))
        if len(found[-1].name) < 2:
            break
    return found


def anchors(value: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the windows at ``start`` their anchor's name and place, the first word of its context."""
    name, place = np.zeros(len(start), U), np.zeros(len(start), np.int64)
    open_ = np.arange(len(start))
    for depth, level in reversed(list(enumerate(levels(value)))):
        s = start[open_]
        first = np.searchsorted(level.lo, s, "left")
        last = np.searchsorted(level.hi, s + WINDOW, "right") - 1
        ok = first <= last
        if not ok.any():
            continue
        first, last, rows = first[ok], last[ok], open_[ok]
        code = mix(level.name + U(depth + 1))
        # The least code in [first, last], and the first symbol that has it, by a table of the
        # least of 1, 2, 4 ... symbols. The code's upper bits decide, then the place.
        packed = (code & ~PLACE) | (np.arange(len(code), dtype=U) & PLACE)
        span = last - first + 1
        power = np.frexp(span)[1] - 1
        least, best = packed, np.empty(len(rows), U)
        for p in range(int(power.max()) + 1):
            if p:
                half = 1 << (p - 1)
                least = np.minimum(least[:-half], least[half:])
            own = np.flatnonzero(power == p)
            best[own] = np.minimum(least[first[own]], least[last[own] - (1 << p) + 1])
        which = first + ((best - first.astype(U)) & PLACE).astype(np.int64)
        name[rows], place[rows] = code[which], level.lo[which]
        open_ = open_[~ok]
        if not len(open_):
            break
    return name, place


def _windows(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows, with separators between texts counted, and each text's shift."""
    n = np.diff(words.bounds)
    shift = np.arange(len(n)) + 1
    count = np.maximum(n - WINDOW + 1, 0)
    text = np.repeat(np.arange(len(n)), count)
    inside = np.arange(count.sum()) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return (words.bounds[:-1] + shift)[text] + inside, text


def _separated(words: Words) -> np.ndarray:
    """The words with a separator before, between and after the texts."""
    n = len(words.start)
    out = np.full(n + len(words) + 1, U(0x6A09E667F3BCC909), U)
    out[np.arange(n) + 1 + np.repeat(np.arange(len(words)), np.diff(words.bounds))] = words.value
    return out


def _window_values(value: np.ndarray) -> np.ndarray:
    """A 64-bit value of the window at each place."""
    n = len(value) - WINDOW + 1
    h = np.zeros(max(n, 0), U)
    for k in range(WINDOW if n > 0 else 0):
        h = (h ^ value[k : k + n]) * U(0x9FB21C651E98DF25)
        h ^= h >> U(32)
    return h


def _served(batch: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words, separated values, and of each stretch of windows with one anchor occurrence: text, first window, count, name."""
    words = Words(batch)
    value = _separated(words)
    start, text = _windows(words)
    if not len(start):
        none = np.zeros(0, np.int64)
        return words, value, none, none, none, none.astype(U)
    name, place = anchors(value, start)
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (name[1:] != name[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(new)
    return words, value, text[first], start[first], np.diff(np.append(first, len(start))), name[first]


def _found_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, k, anchor, times), and for each text that has windows (doc_id, k, two values of all its words)."""
    for batch in batches:
        ids, ks = column(batch, "doc_id"), column(batch, "k")
        for begin, texts in grouped(text_bytes(batch)):
            words, _, text, _, _, name = _served(texts)
            order = np.lexsort((name, text))
            text, name = text[order], name[order]
            new = np.flatnonzero(np.concatenate(([True], (name[1:] != name[:-1]) | (text[1:] != text[:-1])))) if len(name) else order
            rows = np.flatnonzero(np.diff(words.bounds) >= WINDOW)
            whole = [sequence_hash(words.value, words.bounds, seed)[rows].view(np.int64) for seed in (1, 2)]
            at = pa.array(begin + np.concatenate((text[new], rows)))
            none = len(new)
            yield pa.record_batch(
                [
                    ids.take(at),
                    ks.take(at),
                    pa.array(np.concatenate((name[new].view(np.int64), whole[0]))),
                    pa.array(np.concatenate((np.zeros(none, np.int64), whole[1])), mask=np.concatenate((np.ones(none, bool), np.zeros(len(rows), bool)))),
                    pa.array(np.concatenate((np.diff(np.append(new, len(name))), np.ones(len(rows), np.int64))).astype(np.int32)),
                ],
                ["doc_id", "k", "anchor", "whole", "times"],
            )


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows whose anchor is in the row's ``anchors``, a row for each anchor occurrence."""
    for batch in batches:
        ids, ks = column(batch, "doc_id"), column(batch, "k")
        listed, shares = column(batch, "anchors"), column(batch, "shares")
        ends = np.append(0, np.cumsum(listed.value_lengths().to_numpy()))
        listed, shares = listed.flatten().to_numpy(), shares.flatten().to_numpy()
        for begin, texts in grouped(_unpacked(batch)):
            words, value, text, first, count, name = _served(texts)
            share = np.zeros(len(name), np.int32)
            bounds = np.searchsorted(text, np.arange(len(texts) + 1))
            for i in range(len(texts)):
                own, asked = slice(bounds[i], bounds[i + 1]), slice(ends[begin + i], ends[begin + i + 1])
                order = np.argsort(listed[asked])
                known = listed[asked][order]
                at = np.minimum(np.searchsorted(known, name[own].view(np.int64)), len(known) - 1)
                share[own] = np.where(known[at] == name[own].view(np.int64), shares[asked][order][at], 0)
            take = np.flatnonzero(share)
            if not len(take):
                continue
            h = _window_values(value).view(np.int64)
            text, first, size = text[take], first[take], count[take]
            stops = np.cumsum(size)
            flat = h[np.repeat(first - (stops - size), size) + np.arange(stops[-1])]
            at = pa.array(begin + text)
            yield pa.record_batch(
                [
                    ids.take(at),
                    ks.take(at),
                    pa.array(name[take].view(np.int64)),
                    pa.array(share[take]),
                    pa.array((first - words.bounds[text] - text - 1).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.append(0, stops).astype(np.int32)), pa.array(flat)),
                ],
                ["doc_id", "k", "anchor", "shares", "first", "windows"],
            )


def _without(batches: Iterator[pa.RecordBatch], layout: bool) -> Iterator[pa.RecordBatch]:
    """The kept words; ``found`` has (first, mask) of repeated windows, or first -1 for all words.

    layout: a text that loses nothing stays as it is.
    """
    for batch in batches:
        kept, n_words, n_removed = [], [], []
        for text, found in zip(_unpacked(batch), column(batch, "found").to_pylist(), strict=True):
            words = text.split()
            gone = np.zeros(len(words) + WINDOW, bool)
            for x in found or ():
                if x["first"] < 0:
                    gone[:] = True
                    break
                for i in range(x["mask"].bit_length()):
                    if x["mask"] >> i & 1:
                        gone[x["first"] + i : x["first"] + i + WINDOW] = True
            gone = gone[: len(words)]
            if layout and not gone.any():
                kept.append(text)
            else:
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words))
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
        yield pa.record_batch(
            [column(batch, "row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["row", "n_words", "n_removed", "kept"],
        )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text compressed, for the two times that it is shuffled."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        z = [press.compress(x or b"") for x in text_bytes(batch)]
        names = ["row", "doc_id", "k"]
        yield pa.record_batch([*(column(batch, c) for c in names), pa.array(z, pa.binary())], [*names, "z"])


def _unpacked(batch: pa.RecordBatch) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(x) for x in column(batch, "z").to_pylist()]


def _same(a: str, b: str) -> list:
    return [F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")), F.col(f"{a}.k") == F.col(f"{b}.k")]


def _local(windows: DataFrame) -> DataFrame:
    """A row for each window, with the number of equal ones under its anchor."""
    each = windows.repartition("anchor").select("doc_id", "k", "anchor", "first", F.posexplode("windows").alias("i", "h"))
    return each.withColumn("n", F.count("*").over(Window.partitionBy("anchor", "h")))


def _values(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all rows, and how many each row has."""
    lists = table.column("windows").combine_chunks()
    return lists.flatten().to_numpy(), lists.value_lengths().to_numpy()


def _different(key: tuple, table: pa.Table) -> pa.Table:
    """The different windows of a share, for each anchor in as many buckets as it has shares' worth of occurrences."""
    h, size = _values(table)
    anchor, shares = (np.repeat(table.column(c).to_numpy(), size) for c in ("anchor", "shares"))
    bucket = (h.view(U) % shares.astype(U)).astype(np.int32)
    order = np.lexsort((h, bucket, anchor))
    h, bucket, anchor = h[order], bucket[order], anchor[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (anchor[1:] != anchor[:-1])
    h, bucket, anchor = h[new], bucket[new], anchor[new]
    first = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (anchor[1:] != anchor[:-1])))[: len(h)])
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(h)).astype(np.int32)), pa.array(h))
    share = pa.array([key[0].as_py()] * len(first), pa.int64())
    return pa.table({"anchor": pa.array(anchor[first]), "share": share, "bucket": pa.array(bucket[first]), "windows": lists})


def _shared(_: tuple, table: pa.Table) -> pa.Table:
    """For each share the windows of a bucket that another share has too."""
    h, size = _values(table)
    _, at, n = np.unique(h, return_inverse=True, return_counts=True)
    several = n[at] > 1
    share, h = np.repeat(table.column("share").to_numpy(), size)[several], h[several]
    order = np.argsort(share, kind="stable")
    labels, begin = np.unique(share[order], return_index=True)
    lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(h)).astype(np.int32)), pa.array(h[order]))
    return pa.table({"share": pa.array(labels, pa.int64()), "windows": lists})


def _compared(occurrences: pa.Table, elsewhere: pa.Table) -> pa.Table:
    """The repeated windows of a share's documents, a row for each document that has any."""
    occurrences = occurrences.sort_by([("k", "ascending"), ("doc_id", "ascending")])
    h, size = _values(occurrences)
    _, at, n = np.unique(h, return_inverse=True, return_counts=True)
    again = (n[at] > 1) | np.isin(h, _values(elsewhere)[0])
    first = np.cumsum(size) - size
    place = np.arange(len(h)) - np.repeat(first, size)
    mask = np.bitwise_or.reduceat(again.astype(np.int64) << place, first) if len(first) else np.zeros(0, np.int64)
    some = occurrences.select(["doc_id", "k", "first"]).append_column("mask", pa.array(mask)).filter(pa.array(mask != 0)).combine_chunks()
    ks, ids, none = some.column("k").to_numpy(), some.column("doc_id").fill_null(0).to_numpy(), some.column("doc_id").is_null().to_numpy()
    other = np.ones(len(ks), bool)
    other[1:] = (ks[1:] != ks[:-1]) | (ids[1:] != ids[:-1]) | (none[1:] != none[:-1])
    begin = np.flatnonzero(other)
    pairs = pa.StructArray.from_arrays([some.column(c).combine_chunks() for c in ("first", "mask")], ["first", "mask"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(ks)).astype(np.int32)), pairs)
    rows = pa.array(begin)
    return pa.table({"doc_id": some.column("doc_id").take(rows), "k": some.column("k").take(rows), "found": lists})


def _often(windows: DataFrame) -> DataFrame:
    """(doc_id, k, found): the repeated windows of frequent anchors.

    A share holds all of these that its documents have, so that a document gets one row however many it
    has. Shares hand on their different windows, and learn which of them other shares have too.
    """
    shares = 1 + windows.count() // FREQUENT
    share = F.pmod(F.xxhash64("doc_id", "k"), F.lit(shares)).cast("long").alias("share")
    dealt = windows.select("doc_id", "k", "anchor", share, "shares", "first", "windows").groupBy("share")
    different = dealt.applyInArrow(_different, "anchor long, share long, bucket int, windows array<long>")
    shared = different.groupBy("anchor", "bucket").applyInArrow(_shared, "share long, windows array<long>")
    return dealt.cogroup(shared.groupBy("share")).applyInArrow(_compared, f"doc_id long, k long, {FOUND}")


def _masks(repeated: DataFrame) -> DataFrame:
    mask = F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask")
    rows = repeated.groupBy("anchor", "doc_id", "k", "first").agg(mask)
    return rows.select("doc_id", "k", F.array(F.struct("first", "mask")).alias("found"))


def _repeats(keyed: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, k, found): the repeated windows of the documents that have any."""
    spark = keyed.sparkSession
    fresh = lambda frame: materialize(frame, work_dir(spark, "substring"))
    named = fresh(keyed.mapInArrow(_found_anchors, "doc_id long, k long, anchor long, whole long, times int"))
    own, wholes = named.filter("whole is null"), named.filter("whole is not null")

    # Written down, so that the join shuffles anew and a large group of copies can be split.
    equal = fresh(wholes.groupBy("anchor", "whole").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "k")).alias("first")).filter("n > 1"))
    copies = fresh(
        wholes.join(equal, ["anchor", "whole"]).select("doc_id", "k", (F.struct("doc_id", "k") != F.col("first")).alias("later"))
    )
    shares = F.ceil(F.col("n") / FREQUENT).cast("int").alias("shares")
    counted = own.groupBy("anchor").agg(F.sum("times").alias("n")).filter("n > 1").select("anchor", shares)
    listed = own.join(counted, "anchor").groupBy("doc_id", "k").agg(
        F.collect_list("anchor").alias("anchors"), F.collect_list("shares").alias("shares")
    )
    # Written down, so that the files of its shuffles are gone before the texts are shuffled.
    listed = fresh(listed.alias("l").join(copies.filter("later").alias("c"), _same("l", "c"), "left_anti"))
    asked = texts.alias("t").join(listed.alias("l"), _same("t", "l")).select("t.doc_id", "t.k", "t.z", "l.anchors", "l.shares")
    windows = fresh(
        asked.mapInArrow(_window_rows, "doc_id long, k long, anchor long, shares int, first int, windows array<long>")
    )
    masks = _masks(_local(windows.filter("shares = 1")).filter("n > 1"))
    masks = masks.union(_often(windows.filter("shares > 1")))
    whole = F.array(F.struct(F.lit(-1).alias("first"), F.lit(0).cast("long").alias("mask")))
    every = copies.select("doc_id", "k", whole.alias("found"))
    return masks.union(every).groupBy("doc_id", "k").agg(F.flatten(F.collect_list("found")).alias("found"))


@any_names("doc_id", "text", "lang", "source", "n_chars")
def remove_repeats(docs: DataFrame, layout: bool = False) -> DataFrame:
    """``row`` (the columns of ``docs`` without text), n_words, n_removed, kept: one row for each document.

    ``kept`` has the kept words with one space between them; with ``layout`` a text that
    loses nothing is returned unchanged.
    """
    text = F.col("text").cast("string")
    k = F.xxhash64("doc_id", text)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), k.alias("k"))
    row = F.struct(*(docs[c] for c in docs.columns if c != "text"))
    whole = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), k.alias("k"))
    kinds = {f.name: f.dataType for f in whole.schema.fields}
    texts = whole.mapInArrow(_packed, f"row {kinds['row'].simpleString()}, doc_id long, k long, z binary")
    found = _repeats(keyed, texts.select("doc_id", "k", "z"))
    joined = texts.alias("t").join(found.alias("f"), _same("t", "f"), "left").select("t.row", "t.z", "f.found")
    return joined.mapInArrow(lambda b: _without(b, layout), f"row {kinds['row'].simpleString()}, n_words long, n_removed long, kept string")


@any_names("doc_id", "text", "lang", "source", "n_chars")
def substring_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept words as text, where any were removed; documents of which nothing is left go.

    Texts without repeats stay as they are; null text becomes empty. ``n_chars``, if there is one, follows the text.
    """
    out = remove_repeats(docs, layout=True).filter("n_removed = 0 or kept <> ''")
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("kept")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") == 0, columns["n_chars"]).otherwise(F.length("kept")).cast(docs.schema["n_chars"].dataType)
    return out.select(*(columns[c].alias(c) for c in docs.columns))
