"""Tasks give back what they have freed, and yield the same batches."""

from __future__ import annotations

from orderlake.llm import lean


def test_a_task_releases_before_and_after(monkeypatch):
    seen = []
    monkeypatch.setattr(lean, "release", lambda: seen.append("release"))

    def task(batches):
        for b in batches:
            seen.append(b)
            yield b + 1

    assert list(lean.lean(task)(iter([1, 2]))) == [2, 3]
    assert seen == ["release", 1, 2, "release"]


def test_release_runs_here():
    lean.release()
