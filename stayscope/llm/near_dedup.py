"""MinHash near-duplicate detection with fast similarity sketches.

A document's set holds its distinct 5-word shingles (the whole sequence as one where it has
fewer words; none without words). Documents with equal sets form a class; classes are
linked if 4 * |A and B| >= 3 * |A or B|.

The sketch has ``COORDINATES`` coordinates. In round i every element is thrown into a hashed
bin with the value (i, hash); a bin keeps its least value, so the earliest round in which
anything falls into it decides. After as many rounds as there are coordinates, round
COORDINATES + j throws every element into bin j, so that each coordinate is filled for
certain. Large sets are done after a round or two, which makes sketching take time in
proportion to the set rather than to set times coordinates.

Four coordinates make a band, forty bands a sketch: two sets at the threshold share no
band once in four million cases. Classes that share a band are compared on their full sets. A
bucket's members are not paired all with all: in two rounds each is compared with the
bucket's least member of another component. What then still shares a bucket across components
is compared in blocks of bounded size, inside tasks that return links only.

Definitions. Null and blank texts have an empty set and are linked with nothing. A null
doc_id is a document like any other, but is never the least of its component unless
nothing else is there. Repeated rows are separate documents with equal sets. Of a
component of rows with one and the same doc_id all are kept, unless one row of each
component is asked for (``near_dedup``). Columns of the input other than doc_id and text
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, work_dir
from .columns import any_names
from .graph import components
from .words import U, Words, grouped, mix, sequence_hash, text_bytes

SHINGLE = 5
COORDINATES = 160
ROWS_PER_BAND = 4
BANDS = COORDINATES // ROWS_PER_BAND
LOW = U((1 << 52) - 1)
#: Rounds that compare each member of a bucket with one other, before the rest is compared in blocks.
STAR_ROUNDS = 2
#: Nodes of a block of the rest, and elements of all its sets, 8 bytes each, about.
BLOCK, ELEMENTS = 2048, 4_000_000
#: Texts that a worker gets at a time.
BATCH_ROWS = 1000


def shingle_set(value: np.ndarray) -> np.ndarray:
    """The distinct shingles of one text's words, sorted."""
    n = len(value)
    if n < SHINGLE:
        return sequence_hash(value, np.array([0, n]), n) if n else value[:0]
    h = np.zeros(n - SHINGLE + 1, U)
    for k in range(SHINGLE):
        h = mix(h + value[k : k + len(h)] + U(k + 1))
    return np.unique(h)


def sketch(elements: np.ndarray) -> np.ndarray:
    """The coordinates of a set that is not empty."""
    bins, none = COORDINATES, U(0xFFFFFFFFFFFFFFFF)
    out = np.full(bins, none, U)
    for i in range(bins):
        h = mix(elements + U((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        place = ((h >> U(32)) * U(bins)) >> U(32)
        value = (U(i) << U(52)) | (h & LOW)
        np.minimum.at(out, place.astype(np.int64), value)
        if (out != none).all():
            return out
    for j in np.flatnonzero(out == none):
        h = mix(elements + U((bins + int(j) + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        out[j] = (U(bins + int(j)) << U(52)) | (h & LOW).min()
    return out


def bands(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    rows = coordinates.reshape(BANDS, ROWS_PER_BAND)
    key = np.arange(1, BANDS + 1, dtype=U)
    for k in range(ROWS_PER_BAND):
        key = mix(key + rows[:, k])
    return key


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for _, texts in grouped(text_bytes(batch)):
        words = Words(texts, lower=True)
        for i in range(len(words)):
            yield shingle_set(words.value[words.bounds[i] : words.bounds[i + 1]])


def _node(s: np.ndarray) -> bytes | None:
    if not len(s):
        return None
    with np.errstate(over="ignore"):
        two = [mix(s + U(1)).sum(dtype=U), mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U) + U(len(s))]
    return np.array(two, U).astype(">u8").tobytes()


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, size, keys = [], [], []
        for s in _sets(batch):
            node.append(_node(s))
            size.append(len(s))
            keys.append(bands(sketch(s)).view(np.int64) if len(s) else None)
        yield pa.record_batch(
            [
                *(batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "k")),
                pa.array(node, pa.binary()),
                pa.array(size, pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
            ],
            ["doc_id", "k", "node", "n", "bands"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(_node(s), s.tobytes()) for s in _sets(batch)]
        yield pa.record_batch(
            [pa.array([x[0] for x in found], pa.binary()), pa.array([x[1] for x in found], pa.binary())], ["node", "elements"]
        )


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for a, b in zip(batch["ea"].to_pylist(), batch["eb"].to_pylist(), strict=True):
            x, y = np.frombuffer(a, U), np.frombuffer(b, U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= 75 * (len(x) + len(y) - both))
        yield pa.record_batch([batch["a"], batch["b"], pa.array(ok, pa.bool_())], ["a", "b", "linked"])


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (group, x, y); the links within each of these, but between different labels only."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = (row["group"], row["x"], row["y"])
            if own != key:
                yield from _links_within(key, rows)
                key, rows = own, []
            rows.append(row)
    yield from _links_within(key, rows)


def _links_within(key: tuple | None, rows: list[dict]) -> Iterator[pa.RecordBatch]:
    if len(rows) < 2:
        return
    nodes = [r["node"] for r in rows]
    names: dict[bytes, int] = {}
    label = np.array([names.setdefault(r["label"], len(names)) for r in rows])
    own = np.array([r["own"] for r in rows])
    keys = np.array([r["bands"] for r in rows], np.int64)
    sets = [np.frombuffer(r["elements"], U) for r in rows]
    size = np.array([len(x) for x in sets])
    found = []
    for i in range(len(rows) - 1):
        rest = slice(i + 1, None)
        ok = (label[rest] != label[i]) & (4 * np.minimum(size[rest], size[i]) >= 3 * np.maximum(size[rest], size[i]))
        if key[1] != key[2]:
            ok &= own[rest] != own[i]
        near = i + 1 + np.flatnonzero(ok)
        near = near[(keys[near] == keys[i]).any(1)]
        if not len(near):
            continue
        flat = np.concatenate([sets[j] for j in near])
        at = np.minimum(np.searchsorted(sets[i], flat), size[i] - 1)
        both = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.cumsum(size[near]) - size[near])
        for j in near[100 * both >= 75 * (size[near] + size[i] - both)]:
            if label[j] != label[i]:
                found.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    if found:
        yield pa.record_batch([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], ["a", "b"])


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and k: rows that agree in doc_id and k are repeated rows."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64("doc_id", text).alias("k"))


@any_names("doc_id", "text", "lang", "source", "n_chars")
def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, k, n_shingles, component_id, kept: one row for each row of ``docs`` (doc_id, text)."""
    return _result(*_linked(docs))


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, k, node, n, bands) of each row, and (node, label) for the nodes that have links."""
    spark = docs.sparkSession
    fresh = lambda frame: materialize(frame, work_dir(spark, "near"))
    keyed = _keyed(docs)
    described = keyed.mapInArrow(_described, "doc_id long, k long, node binary, n long, bands array<long>")
    about = materialize(described, work_dir(spark, "near"), BATCH_ROWS)
    named = about.filter("node is not null")
    rows = named.groupBy("node").agg(F.min("bands").alias("bands")).select("node", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    members = fresh(rows.join(shared.select("band"), "band").select("band", "node"))
    first = named.groupBy("node").agg(F.min(F.struct("doc_id", "k")).alias("first"), F.max("n").alias("n"), F.min("bands").alias("bands"))
    classes = fresh(first.join(members.select("node").distinct(), "node"))
    members = fresh(members.join(classes.select("node", "n"), "node"))
    return about, _linked_nodes(keyed, classes, members, fresh)


def _linked_nodes(keyed: DataFrame, classes: DataFrame, members: DataFrame, fresh) -> DataFrame:
    """(node, label) for the nodes that have links."""
    firsts = classes.select(F.col("first.doc_id").alias("doc_id"), F.col("first.k").alias("k"))
    same = [F.col("t.doc_id").eqNullSafe(F.col("f.doc_id")), F.col("t.k") == F.col("f.k")]
    texts = keyed.alias("t").join(firsts.alias("f"), same, "left_semi")
    sets = fresh(texts.select("text").mapInArrow(_full_sets, "node binary, elements binary").groupBy("node").agg(F.first("elements").alias("elements")))
    one, two = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea")), sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"))

    def judged(pairs: DataFrame) -> DataFrame:
        return fresh(pairs.join(one, "a").join(two, "b").mapInArrow(_confirmed, "a binary, b binary, linked boolean"))

    def mixed(labels: DataFrame | None) -> DataFrame:
        """The members of the buckets that hold several components, with their bucket's ends."""
        now = members.withColumn("label", F.col("node"))
        if labels is not None:
            now = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        own = F.struct("label", "node", "n")
        ends = now.groupBy("band").agg(F.min(own).alias("lo"), F.max(own).alias("hi"))
        return now.join(ends.filter("lo.label <> hi.label"), "band")

    labels = tested = None
    for _ in range(STAR_ROUNDS):
        other = F.when(F.col("label") != F.col("lo.label"), F.col("lo")).otherwise(F.col("hi"))
        pairs = mixed(labels).select("node", "n", other.alias("o")).filter("4 * least(n, o.n) >= 3 * greatest(n, o.n)")
        pairs = pairs.select(F.greatest("node", "o.node").alias("a"), F.least("node", "o.node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        found = judged(pairs)
        tested = found if tested is None else tested.union(found)
        labels = components(tested.filter("linked").select("a", "b"))
    left = fresh(mixed(labels).select("node", "label", F.col("lo.node").alias("least")))
    more = fresh(_residual(left, classes, sets))
    return components(tested.filter("linked").select("a", "b").union(more))


def _residual(left: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between different components of ``left`` (node, label, least of its bucket).

    Nodes that buckets connect, directly or not, make a group. A group's nodes are dealt to
    blocks, and every two blocks meet in one task, which returns links only.
    """
    groups = components(left.select(F.col("node").alias("a"), F.col("least").alias("b"))).withColumnRenamed("label", "group")
    nodes = left.groupBy("node").agg(F.first("label").alias("label")).join(groups, "node")
    load = F.greatest(F.count("*") / BLOCK, F.sum("n") / ELEMENTS)
    blocks = groups.join(classes.select("node", "n"), "node").groupBy("group").agg(F.ceil(load).cast("int").alias("blocks"))
    dealt = nodes.join(blocks, "group").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = ["group", "x", "y"]
    dealt = dealt.select("group", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "label")
    whole = dealt.join(classes.select("node", "bands"), "node").join(sets, "node").repartition(*key).sortWithinPartitions(*key, "node")
    return whole.select(*key, "own", "node", "label", "bands", "elements").mapInArrow(_block_links, "a binary, b binary")


def _result(about: DataFrame, links: DataFrame) -> DataFrame:
    nodes = about.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    labelled = nodes.join(links, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_node = labelled.join(least, "label").select("node", "component_id")
    whole = about.select("doc_id", "k", "n", "node").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return whole.select(
        "doc_id", "k", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def _leaders(about: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, k): the least row of each component, null doc_ids last. Rows without words have no other component than themselves."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k")
    nodes = about.filter("node is not null").groupBy("node").agg(F.min(place).alias("least"))
    labelled = nodes.join(links, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min("least").alias("least")).select("least.doc_id", "least.k")
    return least.unionByName(about.filter("node is null").select("doc_id", "k").distinct())


@any_names("doc_id", "text", "lang", "source", "n_chars")
def near_dedup(docs: DataFrame, one_each: bool = False) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller doc_id.

    Rows that repeat both doc_id and text stay or go together. With ``one_each`` exactly one
    row of each component stays, also where its ids are equal or null: of the rows with the
    least doc_id one with the least hash of id and text, and one of its repeated rows.
    """
    about, links = _linked(docs)
    kept = _leaders(about, links) if one_each else _result(about, links).filter("kept").select("doc_id", "k").distinct()
    key = [F.col("doc_id").cast("long").alias("__id"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("__k")]
    own = docs.select("*", *key)
    left = own.join(kept, own["__id"].eqNullSafe(kept["doc_id"]) & (own["__k"] == kept["k"]), "left_semi")
    return (left.dropDuplicates(["__id", "__k"]) if one_each else left).drop("__id", "__k")
