"""Line dedup of documents that are in the table several times."""

from __future__ import annotations

from stayscope.llm import line_dedup


def test_repeated_rows_are_one_document(spark, monkeypatch):
    several = "\n".join(f"line {i}" for i in range(40))
    rows = [(1, several)] * 5 + [(None, "x\ny\nz")] * 3 + [(2, "head\n" + several), (3, "alone\nhere")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    most, ranked = [], line_dedup._ranked

    def counted(keyed, key):
        most.append(keyed.count())
        assert most[-1] <= 100, "the places of repeated rows meet all with all"
        return ranked(keyed, key)

    monkeypatch.setattr(line_dedup, "_ranked", counted)
    found = [(r["row"]["doc_id"], r["n_lines"], r["n_removed"], r["n_runs"]) for r in line_dedup.remove_copies(frame).collect()]
    assert sorted(found, key=str) == sorted([(1, 40, 0, 0)] * 5 + [(None, 3, 0, 0)] * 3 + [(2, 41, 40, 1), (3, 2, 0, 0)], key=str)
    assert most[0] == 40 + 3 + 41 + 2
