"""Lists in state as segments of bounded size."""

from __future__ import annotations

from tidemark.streaming import processors
from tidemark.streaming.processors import SegmentedList


class Entries(dict):
    """Map state as a dictionary."""

    def updateValue(self, key, value):
        self[key] = value

    def getValue(self, key):
        return self[key]

    def containsKey(self, key):
        return key in self

    def iterator(self):
        return iter(self.items())


class Handle:
    def getMapState(self, *_):
        return Entries()


def test_small_batches_fill_a_segment(monkeypatch):
    monkeypatch.setattr(processors, "SEGMENT", 4)
    kept, size = SegmentedList(Handle(), "list_query", "bigint"), 0
    for n in (1, 1, 3, 0, 9, 2):
        kept.add_all(size, list(range(size, size + n)))
        size += n
    assert kept.get() == list(range(size))
    assert sorted(kept.segments) == [(0,), (4,), (8,), (12,)]


def test_segments_of_other_sizes_stay(monkeypatch):
    monkeypatch.setattr(processors, "SEGMENT", 4)
    kept = SegmentedList(Handle(), "list_query", "bigint")
    kept.segments.update({(0,): ([0],), (1,): ([1, 2, 3],), (4,): ([4],), (5,): ([5],)})
    kept.add_all(6, [6, 7, 8])
    kept.add_all(9, [9])
    assert kept.get() == list(range(10))
