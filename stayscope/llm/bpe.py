"""Byte-level BPE of whole texts, with long texts encoded in parts that are then joined.

The pattern cuts a text into pieces, each of which BPE encodes on its own. The scan of the
pattern has no memory: from a right boundary on it depends on nothing before. And an
encoding is the BPE of its bytes if every two neighbouring tokens, encoded together, give
themselves. So parts can be encoded apart and joined:

* Texts of more than ``CHUNK`` characters are cut into chunks, which Spark encodes in
  parallel tasks. Neighbouring chunks are joined pairwise, level by level: the scan is
  repeated over a window of pieces around the join, which grows until its first piece is
  the left side's and its last boundary is one of the right side's.
* A piece of more than ``LONG`` bytes without a place to cut is encoded by halves, which
  are joined the same way over a window of tokens that grows until its first token is the
  left side's and its last token is the right side's.

Definitions. Null text is the empty text, without ids. Strings of special tokens in a text
become those tokens, as the library does by default. Repeated rows and null doc_ids are
documents like any other.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, work_dir
from .columns import any_names
from .words import Places, Stretches, column

#: The pattern that cuts texts into pieces for this kind of vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts in Latin-1, whose letters, numbers and white space are these (fixed values).
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
LATIN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
CHUNK = 32_768
LONG = 512
#: Pieces a task remembers the ids of.
REMEMBERED = 800_000


def shown_bytes() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Coder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path) as f:
            spec = json.load(f)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        spec |= {"added_tokens": [], "pre_tokenizer": None, "post_processor": None, "truncation": None, "padding": None}
        self.bare = Tokenizer.from_str(json.dumps(spec))
        chars = shown_bytes()
        self.shown = dict(enumerate(chars))
        byte = {c: b for b, c in enumerate(chars)}
        vocab = spec["model"]["vocab"] | self.special
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = token.encode() if token in self.special else bytes(byte[c] for c in token)
        self.table = Stretches(np.uint8)
        self.table.add(np.fromiter(map(len, self.bytes), np.int64, len(self.bytes)), np.frombuffer(b"".join(self.bytes), np.uint8))
        self.cut, self.latin = regex.compile(PATTERN), re.compile(LATIN)
        self.beyond_latin = re.compile(r"[^\x00-\xff]").search
        self.specials = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.clear()

    def clear(self) -> None:
        self.places, self.known = Places(), Stretches(np.int32)

    def of_bytes(self, raw: bytes) -> list[int]:
        """BPE of some bytes as one piece."""
        return self.bare.encode(raw.decode("latin-1").translate(self.shown), add_special_tokens=False).ids

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring parts of one piece, from theirs."""
        width = 4
        while True:
            a, b = left[-width:], right[:width]
            both = self.of_bytes(b"".join(self.bytes[i] for i in a + b))
            if (len(a) == len(left) or both[0] == a[0]) and (len(b) == len(right) or both[-1] == b[-1]):
                return left[: len(left) - len(a)] + both + right[len(b) :]
            width *= 2

    def tree(self, raw: bytes) -> list[int]:
        """BPE of a piece of any length, by halves."""
        if len(raw) <= LONG:
            return self.of_bytes(raw)
        half = len(raw) // 2
        return self.join(self.tree(raw[:half]), self.tree(raw[half:]))

    def pieces(self, text: str) -> list[str]:
        return (self.cut if self.beyond_latin(text) else self.latin).findall(text)

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, joined, and where each piece's end. New pieces go through the tokenizer in one call."""
        if len(self.places) > REMEMBERED:
            self.clear()
        at = self.places.of(pieces)
        new = [p.encode() for p in self.places.taken()]
        if new:
            coded = iter(self.bare.encode_batch([r.decode("latin-1").translate(self.shown) for r in new if len(r) <= LONG], add_special_tokens=False))
            ids = [next(coded).ids if len(r) <= LONG else self.tree(r) for r in new]
            self.known.add(np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(chain.from_iterable(ids), np.int32))
        return self.known.of(at)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of some texts."""
        cut: list[list[str]] = []
        tokens: list[tuple[int, int, int]] = []  # text, pieces before, special id
        for i, text in enumerate(texts):
            if self.specials and any(t in text for t in self.special):
                own: list[str] = []
                for part in self.specials.split(text):
                    if part in self.special:
                        tokens.append((i, len(own), self.special[part]))
                    else:
                        own += self.pieces(part)
                cut.append(own)
            else:
                cut.append(self.pieces(text))
        flat, ends = self.ids(list(chain.from_iterable(cut)))
        ends = np.append(0, ends)
        begins = np.cumsum([0, *map(len, cut)])
        out = [flat[a:b] for a, b in zip(ends[begins], ends[begins[1:]], strict=False)]
        for i in {t[0] for t in tokens}:
            own = [(n, t) for j, n, t in tokens if j == i]
            where = [ends[begins[i] + n] - ends[begins[i]] for n, _ in own]
            out[i] = np.insert(out[i], where, [t for _, t in own])
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of joined lists of ids, given where each ends."""
        flat, stops = self.table.of(ids)
        stops = np.append(0, stops)[np.append(0, ends)]
        raw = flat.tobytes()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(stops.tolist(), stops[1:].tolist(), strict=False)]

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([len(ids)]))[0]

    def part(self, text: str) -> Part:
        pieces = self.pieces(text)
        flat, ends = self.ids(pieces)
        return Part(pieces, [x.tolist() for x in np.split(flat, ends[:-1])] if pieces else [])

    def joined(self, left: Part, right: Part) -> Part:
        """The pieces and ids of two neighbouring parts of a text."""
        if not left.pieces or not right.pieces:
            return left if left.pieces else right
        back, ahead = 2, 4
        while True:
            a, b = left.pieces[-back:], right.pieces[:ahead]
            # One more character, as the pattern looks one ahead.
            more = right.pieces[ahead][0] if ahead < len(right.pieces) else ""
            window = "".join(a + b)
            ends, found, at = {0}, [], 0
            for p in b[:-1] if more else b:
                at += len(p)
                ends.add(at)
            reach = len(window) - sum(map(len, b))
            for m in self.cut.finditer(window + more):
                if m.start() >= reach and m.start() - reach in ends:
                    break
                found.append(m.group())
                if not more and m.end() == len(window):
                    break
            size = sum(map(len, found))
            agreed = size >= reach and size - reach in ends and (back >= len(left.pieces) or found[:1] == a[:1])
            if agreed:
                taken = [0, *np.cumsum([len(p) for p in b])].index(size - reach)
                ids = []
                for p in found:
                    if taken and len(p) > LONG and p == a[-1] + b[0]:
                        ids.append(self.join(left.ids[-1], right.ids[0]))
                    else:
                        ids.append(self.ids([p])[0].tolist())
                n = len(left.pieces) - len(a)
                return Part(left.pieces[:n] + found + right.pieces[taken:], left.ids[:n] + ids + right.ids[taken:])
            back, ahead = back * 2, ahead * 2

    def all_joined(self, parts: list[Part]) -> list[int]:
        while len(parts) > 1:
            pairs = [self.joined(parts[i], parts[i + 1]) for i in range(0, len(parts) - 1, 2)]
            parts = pairs + parts[len(pairs) * 2 :]
        return [i for ids in parts[0].ids for i in ids] if parts else []


class Part:
    """Pieces of a text and their ids."""

    def __init__(self, pieces: list[str], ids: list[list[int]]):
        self.pieces, self.ids = pieces, ids


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


def _id_arrays(lists: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int32)))


def _id_lists(lists: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _coded(row: pa.Array, lists: list[np.ndarray], code: Coder, decoded: bool) -> pa.RecordBatch:
    ids = _id_arrays(lists)
    if not decoded:
        return pa.record_batch([row, ids], ["row", "ids"])
    return pa.record_batch([row, ids, _texts(ids, code)], ["row", "ids", "decoded"])


def _texts(ids: pa.Array, code: Coder) -> pa.Array:
    ends = np.cumsum(ids.value_lengths().fill_null(0).to_numpy())
    return pa.array(code.decode_all(ids.flatten().to_numpy().astype(np.int64), ends), pa.string())


def _encoded(batches: Iterator[pa.RecordBatch], path: str, decoded: bool) -> Iterator[pa.RecordBatch]:
    code = coder(path)
    gc.disable()  # what is remembered has no cycles
    try:
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                some = batch.slice(begin, 64)
                lists = code.encode_all([x or "" for x in column(some, "text").to_pylist()])
                yield _coded(column(some, "row"), lists, code, decoded)
    finally:
        gc.enable()  # for the worker's other tasks


def _chunk_ids(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """The pieces of a chunk, as their lengths in characters, and the ids with their number for each piece."""
    code = coder(path)
    for batch in batches:
        for begin in range(0, batch.num_rows, 64):
            some = batch.slice(begin, 64)
            parts = [code.part(x) for x in column(some, "chunk").to_pylist()]
            names = ["rid", "segment", "place", "chunk"]
            yield pa.record_batch(
                [
                    *(column(some, n) for n in names),
                    _id_lists([[len(p) for p in x.pieces] for x in parts]),
                    _id_lists([[len(i) for i in x.ids] for x in parts]),
                    _id_lists([[i for ids in x.ids for i in ids] for x in parts]),
                ],
                [*names, "sizes", "counts", "ids"],
            )


def _cut(values, sizes: list[int]) -> list:
    ends = np.cumsum([0, *sizes]).tolist()
    return [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _whole(batches: Iterator[pa.RecordBatch], path: str, decoded: bool) -> Iterator[pa.RecordBatch]:
    code = coder(path)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            segments: dict[int, list[Part]] = {}
            between: dict[int, int] = {}
            for x in sorted(column(row, "chunks").to_pylist()[0], key=lambda x: (x["segment"], x["place"])):
                if x["segment"] % 2:
                    between[x["segment"]] = code.special[x["chunk"]]
                else:
                    segments.setdefault(x["segment"], []).append(Part(_cut(x["chunk"], x["sizes"]), _cut(x["ids"], x["counts"])))
            out: list[int] = []
            for s in sorted({*segments, *between}):
                out += [between[s]] if s in between else code.all_joined(segments[s])
            yield _coded(column(row, "row"), [np.array(out, np.int32)], code, decoded)


@any_names("doc_id", "text", "lang", "source", "n_chars")
def encode(docs: DataFrame, tokenizer: str, chunk: int = CHUNK, decoded: bool = False) -> DataFrame:
    """``row`` (the columns of ``docs`` without text) and ids, an array of the whole text's ids.

    decoded: also the text that the ids decode to, as ``decode`` gives it, in the same pass.
    """
    row = F.struct(*(docs[c] for c in docs.columns if c != "text"))
    whole = docs.select(row.alias("row"), F.col("text").cast("string").alias("text"))
    kind = f"row {whole.schema['row'].dataType.simpleString()}, ids array<int>" + ", decoded string" * decoded
    long_text = F.coalesce(F.length("text"), F.lit(0)) > chunk
    short = whole.filter(~long_text).mapInArrow(lambda b: _encoded(b, tokenizer, decoded), kind)

    # Written down, as the numbers are used more than once.
    numbered = whole.filter(long_text).withColumn("rid", F.monotonically_increasing_id())
    with_id = materialize(numbered, work_dir(docs.sparkSession, "long-texts"))
    special = "|".join(regex.escape(x) for x in sorted(_specials(tokenizer), key=len, reverse=True))
    # Texts at even places, special tokens at odd ones.
    texts = F.split("text", special) if special else F.array("text")
    tokens = F.expr(f"regexp_extract_all(text, '({special})', 1)".replace("\\", "\\\\")) if special else F.array().cast("array<string>")
    parts = with_id.select("rid", F.posexplode(texts).alias("n", "part"), tokens.alias("tokens"))
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.length("part") - 1, F.lit(0)), F.lit(chunk)), lambda i: F.col("part").substr(i + 1, F.lit(chunk)))
    chunks = parts.select("rid", (2 * F.col("n")).alias("segment"), F.posexplode(cut).alias("place", "chunk"))
    marks = with_id.select("rid", F.posexplode(tokens).alias("n", "chunk")).select("rid", (2 * F.col("n") + 1).alias("segment"), F.lit(0).alias("place"), "chunk")
    coded = chunks.repartition("rid", "segment", "place").mapInArrow(
        lambda b: _chunk_ids(b, tokenizer), "rid long, segment int, place int, chunk string, sizes array<int>, counts array<int>, ids array<int>"
    )
    empty = F.array().cast("array<int>")
    every = coded.unionByName(marks.select("*", empty.alias("sizes"), empty.alias("counts"), empty.alias("ids")))
    lists = every.groupBy("rid").agg(F.collect_list(F.struct("segment", "place", "chunk", "sizes", "counts", "ids")).alias("chunks"))
    joined = lists.join(with_id.select("rid", "row"), "rid").select("row", "chunks")
    return short.unionByName(joined.mapInArrow(lambda b: _whole(b, tokenizer, decoded), kind))


def _specials(path: str) -> list[str]:
    with open(path) as f:
        return [x["content"] for x in json.load(f)["added_tokens"]]


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    code = coder(path)
    for batch in batches:
        for begin in range(0, batch.num_rows, 64):
            some = batch.slice(begin, 64)
            ids = column(some, "ids")
            yield pa.record_batch([column(some, "row"), ids, _texts(ids, code)], ["row", "ids", "decoded"])


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` (row, ids) with the decoded text; bytes that are no UTF-8 become U+FFFD."""
    kind = f"row {encoded.schema['row'].dataType.simpleString()}, ids array<int>, decoded string"
    return encoded.mapInArrow(lambda b: _decoded(b, tokenizer), kind)
