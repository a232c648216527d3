"""What a worker remembers for one operator is given back when another begins."""

from __future__ import annotations

from stayscope.llm import workers


def test_only_what_others_keep_is_given_back(monkeypatch):
    monkeypatch.setattr(workers, "_kept", {})
    gone: list[str] = []
    workers.remembers("packing", lambda: gone.append("packing"))
    workers.remembers("quality", lambda: gone.append("quality"))
    workers.forget_others("quality")
    assert gone == ["packing"]
    workers.forget_others("quality")
    assert gone == ["packing"]
    workers.forget_others("placing")
    assert gone == ["packing", "quality"]
