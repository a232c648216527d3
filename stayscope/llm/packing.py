"""Packing of tokenized documents into sequences of a fixed length, by minimum bin slack.

A document's ids are cut into full pieces of ``CAPACITY`` and a rest. How many pieces there
are of each length is a table of at most CAPACITY rows whatever the size of the corpus;
packing is planned on it. The longest length that is left opens a sequence, and a subset-sum
over a bitset (bit s: some multiset of the lengths left sums to s) picks the lengths that
fill it closest to its capacity. The counts of that multiset are read off by going back
through the bitsets. The same pattern is then repeated as often as the counts allow. Spark
numbers the pieces of each length and finds each piece's place in the plan from its number.

Definitions. Null and empty texts are one piece with the closing id alone. Repeated rows
and null doc_ids are documents like any other. Columns other than doc_id and text are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, work_dir
from .columns import any_names
from .bpe import shown_bytes
from .words import Places, Stretches, column, grouped, text_bytes
from .workers import forget_others, remembers

CAPACITY = 2048
END_ID = 1
#: Words and pieces of words a task remembers the ids of. Words are soon put together again from pieces.
REMEMBERED, PIECES = 300_000, 700_000
#: The same where ids are handed on: that stage comes behind those of other operators, which leave it less memory.
LEAN = 100_000, 300_000
#: Texts that a worker gets at a time; it remembers a lot besides.
BATCH_ROWS = 1000
#: Bytes of texts whose words are looked up together, each once.
TOGETHER, LEAN_TOGETHER = 4 << 20, 1 << 20
#: Pieces of one length that one task numbers, about.
NUMBERED = 100_000


#: Words of these characters only are left alone by the vocabulary's normalizer but for case, and
#: are cut into the pieces below, which are encoded one by one. All others go to the library whole.
_PLAIN = "!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
#: Their UTF-8 bytes, and the line feed between words: those alone or in front, and those behind the one that leads two.
_SINGLE, _SECOND, _FIRST = np.zeros(256, bool), np.zeros(256, bool), 0xC3
_SINGLE[[0x0A, *range(0x21, 0x7F), _FIRST]] = True
_SECOND[[x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)]] = True
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\n\u00df-\u00f6\u00f8-\u00ff]+|\n")
#: The pattern that _PIECE is right for (fixed value of the vocabulary).
_KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds:
    """Ids of white-space separated words, for a tokenizer whose pieces never span white space."""

    def __init__(self, path: str, most_words: int = REMEMBERED, most_pieces: int = PIECES):
        from tokenizers import Tokenizer

        self.most_words, self.most_pieces = most_words, most_pieces
        with open(path) as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None}))
        self.special = tuple(x["content"] for x in spec["added_tokens"])
        self.by_piece = _pattern(spec) == _KNOWN_PATTERN
        self.bare = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "normalizer": None, "pre_tokenizer": None, "post_processor": None, "truncation": None, "padding": None}))
        self.shown = dict(enumerate(shown_bytes()))
        self.clear()
        self.clear_pieces()

    def clear(self) -> None:
        self.places, self.ids = Places(), Stretches(np.uint32)

    def clear_pieces(self) -> None:
        self.piece_places, self.pieces = Places(), Stretches(np.uint32)

    def plain(self, words: list[bytes]) -> np.ndarray:
        """Which of the words are plain; no word is."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        if not self.by_piece:
            return sizes == 0
        whole = b"\n".join(words) + b"\n"
        data, begins = np.frombuffer(whole, np.uint8), np.cumsum(sizes + 1) - sizes - 1
        good = _SINGLE[data]
        good[1:] |= _SECOND[data[1:]] & (data[:-1] == _FIRST)
        plain = np.logical_and.reduceat(good, begins)
        at = [x.start() for x in re.finditer(rb"<\|", whole)]
        for i in np.unique(np.searchsorted(begins, at, "right") - 1).tolist():
            plain[i] &= not any(x.encode() in words[i] for x in self.special)
        return plain

    def learn(self, words: list[bytes]) -> None:
        if len(self.piece_places) > self.most_pieces:
            self.clear_pieces()
        plain = self.plain(words)
        size = np.zeros(len(words), np.int64)
        # All plain words are cut in one go; a line feed, which has no ids, ends each.
        at = self.piece_places.of(_PIECE.findall(b"".join([w + b"\n" for w in compress(words, plain.tolist())]).decode().lower()))
        new = ["" if p == "\n" else p for p in self.piece_places.taken()]
        shown = "\n".join(new).encode().decode("latin-1").translate(self.shown).split(self.shown[10]) if new else []
        # Handed over as the words of one text, they need no object each, and no threads.
        coded = self.bare.encode(shown, is_pretokenized=True, add_special_tokens=False)
        self.pieces.add(np.bincount(np.array(coded.word_ids, np.int64), minlength=len(new)), np.array(coded.ids, np.uint32))
        flat, ends = self.pieces.of(at)
        if len(at):
            size[plain] = np.diff(ends[at == self.piece_places["\n"]], prepend=0)
        others = [x.ids for x in self.tokenizer.encode_batch([w.decode() for w in compress(words, (~plain).tolist())], add_special_tokens=False)]
        size[~plain] = np.fromiter(map(len, others), np.int64, len(others))
        every = np.zeros(int(size.sum()), np.uint32)
        whose = np.repeat(plain, size)
        every[whose] = flat
        every[~whose] = np.fromiter(chain.from_iterable(others), np.uint32)
        self.ids.add(size, every)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of whole texts, with the closing id."""
        if len(self.places) > self.most_words:
            self.clear()
        # Arrow cuts at the same six characters as ``bytes.split``; white space at an end leaves an empty word, which has no ids.
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        words = lists.flatten().dictionary_encode()
        # only the different words of these texts are looked up
        known = self.places.of(words.dictionary.cast(pa.binary()).to_pylist())
        new = self.places.taken()
        if new:
            self.learn(new)
        flat, ends = self.ids.of(known[words.indices.to_numpy()])
        stops = np.append(0, ends)[lists.offsets.to_numpy()]
        return [np.append(flat[a:b], np.uint32(END_ID)) for a, b in zip(stops, stops[1:], strict=False)]


def _pattern(spec: dict) -> str | None:
    """The pattern by which a vocabulary's first pre-tokenizer cuts."""
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return steps[0].get("pattern", {}).get("Regex")


@lru_cache(maxsize=2)
def _word_ids(path: str, *most: int) -> WordIds:
    return WordIds(path, *most)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    coder = _word_ids(path, *LEAN) if with_ids else _word_ids(path)
    remembers("packing", _word_ids.cache_clear)
    gc.disable()  # what is remembered has no cycles, and it would be walked again and again
    try:
        yield from _cut(batches, coder, capacity, with_ids)
    finally:
        # the worker goes on to other tasks, which need the collector and the buffers' memory
        gc.enable()
        gc.collect()
        pa.default_memory_pool().release_unused()


def _cut(batches: Iterator[pa.RecordBatch], coder: WordIds, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_bytes(batch)
        for begin, some in grouped(texts, LEAN_TOGETHER if with_ids else TOGETHER):
            doc, start, crc, total, parts = [], [], [], [], []
            for i, ids in enumerate(coder.encode(some), begin):
                for at in range(0, len(ids), capacity):
                    part = ids[at : at + capacity]
                    doc.append(i)
                    start.append(at)
                    crc.append(zlib.crc32(part.astype("<u4").tobytes()))
                    total.append(len(ids))
                    parts.append(part)
            columns = {
                "doc_id": column(batch, "doc_id").take(pa.array(doc, pa.int64())),
                "start": pa.array(start, pa.int64()),
                "length": pa.array([len(x) for x in parts], pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array(total, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([x.astype(np.int32) for x in parts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, at most ``counts`` of each, whose sum comes closest to capacity from below."""
    reach, mask, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        left, part = min(counts[length], capacity // length), 1
        while left > 0 and not reach >> capacity:
            part = min(part, left)
            steps.append((length, part, reach))
            reach |= (reach << (length * part)) & mask
            left, part = left - part, part * 2
        if reach >> capacity:
            break
    total, used = reach.bit_length() - 1, {}
    for length, part, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + part
            total -= length * part
    return used


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(repetitions, {length: times}) patterns that use up ``counts``, longest pieces first."""
    left, patterns = {k: v for k, v in counts.items() if v}, []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        used = fullest({k: v for k, v in rest.items() if v}, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        patterns.append((times, used))
        left = {k: v for k, v in ((k, v - times * used.get(k, 0)) for k, v in left.items()) if v}
    return patterns


def _slots(patterns: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first number, times, first sequence, offset), in order of length and number."""
    rows, taken, sequence = [], {}, 0
    for times, used in patterns:
        offset = 0
        for length in sorted(used, reverse=True):
            rows.append((length, taken.get(length, 0), used[length], sequence, offset))
            taken[length] = taken.get(length, 0) + times * used[length]
            offset += length * used[length]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placed(batches: Iterator[pa.RecordBatch], slots: np.ndarray, with_ids: bool) -> Iterator[pa.RecordBatch]:
    if with_ids:  # the ids are sorted next, and what was remembered for encoding is not needed any more
        forget_others("placing")
    bounds = {int(v): (np.searchsorted(slots[:, 0], v), np.searchsorted(slots[:, 0], v, "right")) for v in np.unique(slots[:, 0])}
    for batch in batches:
        length, number = column(batch, "length").to_numpy(), column(batch, "number").to_numpy()
        row = np.zeros(len(length), np.int64)
        for v in np.unique(length):
            lo, hi = bounds[int(v)]
            own = length == v
            row[own] = lo + np.searchsorted(slots[lo:hi, 1], number[own], "right") - 1
        _, first, times, sequence, offset = slots[row].T
        ahead = number - first
        found = {"sequence_id": sequence + ahead // times, "offset": offset + ahead % times * length}
        names = [n for n in batch.schema.names if n != "number"]
        yield pa.record_batch([*(column(batch, n) for n in names), *map(pa.array, found.values())], [*names, *found])


@any_names("doc_id", "text", "lang", "source", "n_chars")
def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids): a row for each piece."""
    spark = docs.sparkSession
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = texts.mapInArrow(lambda b: _pieces(b, tokenizer, capacity, with_ids), kinds)
    if with_ids:
        cut = cut.withColumn("piece", F.monotonically_increasing_id())
    whole = materialize(cut, work_dir(spark, "packing"), BATCH_ROWS)
    pieces = whole.drop("ids")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = 1 + max(counts.values(), default=0) // NUMBERED
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = salted.withColumn("own", F.row_number().over(own)).join(begins, ["length", "salt"])
    numbered = numbered.withColumn("number", F.col("begin") + F.col("own") - 1).select(*pieces.columns, "number")
    slots = _slots(plan(counts, capacity))
    own = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", piece long" * with_ids
    placed = numbered.mapInArrow(lambda b: _placed(b, slots, with_ids), f"{own}, sequence_id long, offset long")
    if not with_ids:
        return placed
    # Python places pieces without their ids, which join them afterwards.
    placed = materialize(placed, work_dir(spark, "placed"))
    joined = placed.join(whole.select("piece", "ids"), "piece")
    return joined.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences, from ``pack(..., with_ids=True)``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"))
