"""Deletion of repeated runs of lines, by a suffix array over line ids.

Every line is replaced by the rank of its two 64-bit hashes among the lines that repeat.
Prefix doubling then ranks the runs of 2, 4, 8 ... lines that start at each place, by sorting
the pairs (rank of the first half, rank of the second half); a global sort is distributed by
range, and a row's number in it is its rank. Suffixes whose prefix has become unique are
settled and leave, so a round handles repeated places only, and the rounds end when none is
left. The places of one rank after round j are an interval of the suffix array with a common
prefix of 2**j lines at least. The first place of an interval is the original, the others
are later copies; what the longest such runs cover is deleted.

Everything is DataFrame operations. The lines of a document stay together only as text.

Definitions. Blank lines (white space only) have no part in runs. A run has ``MIN_LINES``
lines or more in one document; the order of documents is that of doc_id (null first). A
later copy may overlap its original, so of one line repeated many times in a row the first
is kept. Rows that repeat both doc_id and text count as one document. Null text has no lines.
Columns other than doc_id and text are carried along and not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, work_dir
from .columns import any_names

MIN_LINES = 2
PLACE = ["doc_id", "k", "i"]


def _stored(frame: DataFrame) -> DataFrame:
    return materialize(frame, work_dir(frame.sparkSession, "lines"))


def _lines(text: str):
    return F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, "\t\r\x0b\x0c", "    ")) != "")


def _ranked(keyed: DataFrame, key: list[str]) -> DataFrame:
    """``keyed`` (doc_id, k, i, key...) without the rows whose key is unique; ``rank`` in the order of the key."""
    repeated = keyed.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    ranks = _stored(repeated.orderBy(*key).withColumn("rank", F.monotonically_increasing_id()))
    return _stored(keyed.join(ranks, key).select(*PLACE, "rank"))


def _later(ranked: DataFrame, length: int) -> DataFrame:
    """The places of each rank but the first."""
    place = F.struct(*PLACE)
    first = ranked.groupBy("rank").agg(F.min(place).alias("first"))
    return ranked.join(first, "rank").filter(place > F.col("first")).select(*PLACE, F.lit(length).alias("length"))


def _shifted(a: DataFrame, b: DataFrame, by: int) -> DataFrame:
    """Pairs of ranks at places ``by`` lines apart."""
    second = b.select("doc_id", "k", (F.col("i") - by).alias("i"), F.col("rank").alias("second")).alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.k") == F.col("b.k")) & (F.col("a.i") == F.col("b.i"))
    return a.alias("a").join(second, same).select("a.doc_id", "a.k", "a.i", F.col("a.rank").alias("first"), "second")


def later_copies(lines: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(doc_id, k, i, length): later copies of runs; from ``lines`` (doc_id, k, i, h1, h2)."""
    ranked, length, found = _ranked(lines, ["h1", "h2"]), 1, []
    while True:
        if length >= min_lines:
            found.append(_later(ranked, length))
        elif 2 * length > min_lines:
            # min_lines is no power of two: two runs that overlap make one of min_lines
            found.append(_later(_ranked(_shifted(ranked, ranked, min_lines - length), ["first", "second"]), min_lines))
        pairs = _shifted(ranked, ranked, length)
        ranked, length = _ranked(pairs, ["first", "second"]), 2 * length
        if ranked.isEmpty():
            break
    if not found:
        return ranked.select(*PLACE, F.lit(min_lines).alias("length"))
    every = found[0]
    for x in found[1:]:
        every = every.union(x)
    return every.groupBy(*PLACE).agg(F.max("length").alias("length"))


def _spans(copies: DataFrame) -> DataFrame:
    """(doc_id, k, spans): the maximal runs of lines that the copies cover."""
    own = Window.partitionBy("doc_id", "k").orderBy("i")
    end = F.max(F.col("i") + F.col("length") - 1).over(own.rowsBetween(Window.unboundedPreceding, -1))
    opened = copies.withColumn("opens", F.when(F.col("i") <= end + 1, 0).otherwise(1))
    numbered = opened.withColumn("run", F.sum("opens").over(own))
    runs = numbered.groupBy("doc_id", "k", "run").agg(F.min("i").alias("from"), F.max(F.col("i") + F.col("length") - 1).alias("to"))
    return runs.groupBy("doc_id", "k").agg(F.collect_list(F.struct("from", "to")).alias("spans"))


@any_names("doc_id", "text", "lang", "source", "n_chars")
def remove_copies(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``row`` (``docs``), n_lines, n_removed, n_runs, longest_run, kept: one row for each document.

    ``kept`` has the kept lines that are not blank, with one line feed between them.
    """
    text = F.col("text").cast("string")
    k = F.xxhash64("doc_id", text)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), k.alias("k"))
    once = keyed.dropDuplicates(["doc_id", "k"])  # else the places of repeated rows would pair all with all
    each = once.select("doc_id", "k", F.posexplode(_lines("text")).alias("i", "line"))
    lines = _stored(each.select(*PLACE, F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")))
    spans = _spans(later_copies(lines, min_lines))
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), k.alias("k"))
    same = F.col("w.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("w.k") == F.col("s.k"))
    joined = whole.alias("w").join(spans.alias("s"), same, "left").select("w.row", "s.spans")
    joined = joined.withColumn("lines", F.coalesce(_lines(F.col("row.text").cast("string")), F.array().cast("array<string>")))
    gone = lambda i: F.exists("spans", lambda s: (i >= s["from"]) & (i <= s["to"]))
    kept = F.when(F.col("spans").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda _, i: ~gone(i)))
    size = lambda s: s["to"] - s["from"] + 1
    return joined.withColumn("left", kept).select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_removed"),
        F.coalesce(F.size(F.when(F.col("spans").isNotNull(), F.col("spans"))), F.lit(0)).cast("long").alias("n_runs"),
        F.coalesce(F.array_max(F.transform("spans", size)), F.lit(0)).cast("long").alias("longest_run"),
        F.array_join("left", "\n").alias("kept"),
    )


@any_names("doc_id", "text", "lang", "source", "n_chars")
def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` without later copies; documents of which no line is left go, others lose their blank lines with the copies.

    Documents without later copies stay as they are. ``n_chars``, if there is one, follows the text.
    """
    out = remove_copies(docs, min_lines).filter("n_removed = 0 or n_removed < n_lines")
    same = F.col("n_removed") == 0
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    columns["text"] = F.when(same, columns["text"]).otherwise(F.col("kept"))
    if "n_chars" in columns:
        columns["n_chars"] = F.when(same, columns["n_chars"]).otherwise(F.length("kept")).cast(docs.schema["n_chars"].dataType)
    return out.select(*(columns[c].alias(c) for c in docs.columns))
