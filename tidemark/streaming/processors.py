"""State per key, updated batch by batch.

A key's rows of one batch are worked on together with numpy, in their order.
So a task holds at most one key's share of one batch, which the source bounds
by its files per batch.  Each state is written once per key and batch.

Batches must arrive in order: the order of a key's last row is kept with its
state, and a later batch that does not lie wholly behind it fails the query.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import PySparkRuntimeError
from pyspark.serializers import write_int
from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import (
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from tidemark.functions.tokens import CLEAR, CLEAR_WORDS_TOKEN, QUIT_TOKEN

SEGMENT = 8192
#: Rows that are packed at a time, and the most in a packed row that is emitted.
PACK_ROWS = 1 << 19
CHUNK = 1 << 16
LOW_HALF = (1 << 32) - 1


def _sorted(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    parts = list(rows)
    batch = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    return batch.sort_values(order, ignore_index=True)


def packed(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a key that come together as one row, with a list in each column but the keys."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= PACK_ROWS:
            yield from _lists(held, keys)
            held, count = [], 0
    if count:
        yield from _lists(held, keys)


def _lists(held: list[pa.RecordBatch], keys: list[str]) -> list[pa.RecordBatch]:
    rows = pa.Table.from_batches(held)
    names = rows.column_names
    others = [name for name in names if name not in keys]
    groups = rows.group_by(keys, use_threads=False).aggregate([(name, "list") for name in others])
    columns = [groups[name if name in keys else f"{name}_list"] for name in names]
    return pa.table(columns, names).combine_chunks().to_batches()


def _column(values: list) -> np.ndarray:
    """Whole numbers as they are; others as objects."""
    if all(type(value) is int for value in values):
        return np.array(values, dtype=np.int64)
    column = np.empty(len(values), dtype=object)
    column[:] = values
    return column


def _in_order(rows: Iterator[Row], order: list[str], value: str) -> list[np.ndarray]:
    """The columns of the order and a column of whole numbers, of packed rows, sorted."""
    parts = [[_column(row[name]) for name in (*order, value)] for row in rows]
    columns = [np.concatenate(part) if len(part) > 1 else part[0] for part in zip(*parts, strict=True)]
    *places, values = columns
    if any(column.dtype == object for column in places):  # missing places come last
        keys = [[(v is None, 0 if v is None else v) for v in column.tolist()] for column in places]
        ranks = list(zip(*keys, strict=True))
        by = sorted(range(len(ranks)), key=ranks.__getitem__)
    else:
        by = np.lexsort(places[::-1])
    return [column[by] for column in (*places, values.astype(np.int64))]


def _place(batch: pd.DataFrame, order: list[str], row: int) -> tuple:
    """The order of one row, as plain Python values."""
    return tuple(_plain(batch[c].iloc[row]) for c in order)


def _plain(value):
    """A value that state takes: numbers of numpy would be stored as nulls."""
    return value.item() if isinstance(value, np.generic) else value


def _follows(batch: pd.DataFrame, order: list[str], last: tuple) -> tuple:
    """The place of the last row; fails unless all rows lie behind `last`."""
    _check_behind(_place(batch, order, 0), tuple(last))
    return _place(batch, order, -1)


def _check_behind(first: tuple, last: tuple) -> None:
    if last and first <= last:
        raise ValueError(f"batch out of order: {first} after {last}")


def _zoned(stored: tuple, like: tuple) -> tuple:
    """A stored place; its timestamps come back in local time, without their zone."""
    pairs = zip(stored, like, strict=True)
    return tuple(at.astimezone() if at and getattr(zoned, "tzinfo", None) else at for at, zoned in pairs)


def _entry(key: tuple) -> str:
    """The name of a key's map entry, as `keyed.map_key` makes it."""
    return ",".join(str(part) for part in key if part is not None)


def _fields(order: list[tuple[str, str]]) -> str:
    return "".join(f", at_{name} {kind}" for name, kind in order)


def _sums_since(values: np.ndarray, restart: np.ndarray, carried: int) -> np.ndarray:
    """Running sums since, and with, the last restart row; `carried` counts before the first."""

    def scan(v, zero):
        total = np.cumsum(v)
        last = np.maximum.accumulate(np.where(restart, np.arange(len(v)), -1))
        return total - np.where(last >= 0, (total - v)[last], -zero)

    # Halves of 32 bits never pass 64 bits here, so the check is exact.
    low = scan(values & LOW_HALF, np.int64(carried & LOW_HALF))
    high = scan(values >> 32, np.int64(carried >> 32)) + (low >> 32)
    if len(high) and (high.max() >= 1 << 31 or high.min() < -(1 << 31)):
        raise OverflowError("sum past 64 bits")
    return (high << 32) | (low & LOW_HALF)


@contextmanager
def _sent_together(handle: StatefulProcessorHandle) -> Iterator[None]:
    """State writes in here are sent one behind the other; their answers are awaited at the end.

    For writes only: a read in here would not get its answer.  Where Spark's client is
    another one than that of 4.1, each write awaits its own.
    """
    client, waiting = getattr(handle, "_statefulProcessorApiClient", None), []
    if not all(hasattr(client, name) for name in ("sockfile", "_send_proto_message", "_receive_proto_message")):
        yield
        return

    def send(message: bytes) -> None:
        write_int(0, client.sockfile)
        write_int(len(message), client.sockfile)
        client.sockfile.write(message)

    def receive() -> tuple[int, str, bytes]:
        waiting.append(None)
        return 0, "", b""

    client._send_proto_message, client._receive_proto_message = send, receive
    try:
        yield
    finally:
        del client._send_proto_message, client._receive_proto_message
        client.sockfile.flush()
        answers = [client._receive_proto_message() for _ in waiting]
    for status, message, _ in answers:
        if status:
            raise PySparkRuntimeError(f"Error writing state: {message}")


class SegmentedList:
    """A list kept as map entries (first position -> elements) of bounded size.

    Spark's own list state is one value per key, which a long list outgrows.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, element: str):
        self.segments = handle.getMapState(name, "start bigint", f"items array<{element}>")

    def add_all(self, size: int, items: list) -> None:
        """Append to a list of `size` elements; its last segment is filled before one is opened."""
        self.put(*self.joined(size, items))

    def joined(self, size: int, items: list) -> tuple[int, list]:
        """Where to put elements behind a list of `size`, and they behind those of its last segment."""
        start = size // SEGMENT * SEGMENT
        # A map that takes writes only opens a segment for each batch.
        holds = getattr(self.segments, "containsKey", None)
        if items and start < size and holds and holds((start,)):
            [last] = self.segments.getValue((start,))
            if len(last) == size - start:  # else the list was kept in segments of other sizes
                return start, [*last, *items]
        return size, items

    def put(self, start: int, items: list) -> None:
        for at in range(0, len(items), SEGMENT):
            self.segments.updateValue((start + at,), (items[at : at + SEGMENT],))

    def get(self) -> list:
        parts = sorted((start, items) for (start,), (items,) in self.segments.iterator())
        return [item for _, items in parts for item in items]

    def clear(self) -> None:
        self.segments.clear()

    def replace(self, items: list) -> None:
        self.clear()
        self.add_all(0, items)


class ResettableSum(StatefulProcessor):
    """Emits (keys, order, total) of numbers, each but the keys an array; keeps the five states of a key.

    value_query (n, size, order) is the current sum and length, both 0 after a clear;
    list_query the numbers; map_query one entry; reduce_query nothing after a
    clear; keyed_query the last emitted sum, which a clear leaves alone.
    """

    def __init__(self, keys: list[str], order: list[tuple[str, str]], keep_list: bool = True):
        self.keys, self.order, self.keep_list = keys, [name for name, _ in order], keep_list
        self.fields = _fields(order)
        self.emitted = Row(*keys, *self.order, "total")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value_query", f"n bigint, size bigint{self.fields}")
        self.entries = handle.getMapState("map_query", "map_key string", "n bigint")
        self.reduced = handle.getValueState("reduce_query", "n bigint")
        self.latest = handle.getValueState("keyed_query", "n bigint")
        self.items = SegmentedList(handle, "list_query", "bigint") if self.keep_list else None

    def handleInputRows(
        self, key: tuple, rows: Iterator[Row], timerValues: TimerValues
    ) -> Iterator[Row]:
        *places, n = _in_order(rows, self.order, "n")
        clear = n == CLEAR
        total, size, *last = self.value.get() or (0, 0)
        first = tuple(_plain(column[0]) for column in places)
        if last:
            _check_behind(first, _zoned(last, first))
        last = [_plain(column[-1]) for column in places]
        sums = _sums_since(np.where(clear, 0, n), clear, total)
        tail = n[np.flatnonzero(clear)[-1] + 1 :] if clear.any() else n
        restart = len(tail) < len(n)
        held = 0 if restart else size
        if self.items and len(tail):
            start, items = self.items.joined(held, tail.tolist())
        given = np.flatnonzero(~clear)
        with _sent_together(self.handle):
            if restart and size:
                self._clear()
            if len(tail):
                total = int(sums[-1])
                self.entries.updateValue((_entry(key),), (total,))
                self.reduced.update((total,))
                if self.items:
                    self.items.put(start, items)
            else:
                total = 0
            self.value.update((total, held + len(tail), *last))
            if len(given):
                self.latest.update((int(sums[given[-1]]),))
        for at in range(0, len(given), CHUNK):
            some = given[at : at + CHUNK]
            yield self.emitted(*key, *[column[some] for column in places], sums[some])

    def handleInitialState(self, key: tuple, initialState: Row, timerValues: TimerValues) -> None:
        """Takes up what an earlier stream has kept of the key, see `state.saved_sums`."""
        found = initialState["segments"] if self.items else ()
        segments = [self.items.joined(segment["start"], segment["items"]) for segment in found]
        with _sent_together(self.handle):
            for start, items in segments:
                self.items.put(start, items)
            for sums in initialState["sums"]:
                size, total = sums["size"], sums["n"]
                self.value.update((total, size, *[_plain(sums[f"at_{name}"]) for name in self.order]))
                if size:
                    self.entries.updateValue((_entry(key),), (total,))
                    self.reduced.update((total,))
            for n in initialState["latest"]:
                self.latest.update((n,))

    def _clear(self) -> None:
        """Clears every state but the last emitted sum; the value is overwritten."""
        self.entries.clear()
        self.reduced.clear()
        if self.items:
            self.items.clear()


class RunningAverage(StatefulProcessor):
    """Emits (keys, order, avg) from the second number since a clear on.

    Sum and length stand in for the list, which the average alone needs not.
    """

    def __init__(self, keys: list[str], order: list[tuple[str, str]]):
        self.keys, self.order = keys, [name for name, _ in order]
        self.fields = _fields(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("avg", f"total bigint, size bigint{self.fields}")

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        batch = _sorted(rows, self.order)
        n = batch["n"].to_numpy(dtype=np.int64)
        clear = n == CLEAR
        total, size, *last = self.value.get() or (0, 0)
        last = _follows(batch, self.order, last)
        totals = _sums_since(np.where(clear, 0, n), clear, total)
        sizes = _sums_since((~clear).astype(np.int64), clear, size)
        self.value.update((int(totals[-1]), int(sizes[-1]), *last))
        keep = ~clear & (sizes >= 2)
        if keep.any():
            averages = totals[keep].astype(float) / sizes[keep].astype(float)
            yield batch.loc[keep, self.keys + self.order].assign(avg=averages)


class RunningCount(StatefulProcessor):
    """Emits (keys, order, count) per row: how often its key has come up so far."""

    def __init__(self, keys: list[str], order: list[tuple[str, str]]):
        self.keys, self.order = keys, [name for name, _ in order]
        self.fields = _fields(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", f"n bigint{self.fields}")

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        batch = _sorted(rows, self.order)
        before, *last = self.count.get() or (0,)
        last = _follows(batch, self.order, last)
        self.count.update((before + len(batch), *last))
        counts = before + np.arange(1, len(batch) + 1)
        yield batch[self.keys + self.order].assign(count=counts)


class TakeUntil(StatefulProcessor):
    """Emits the rows of a key before its first marker; keeps whether that has come."""

    def __init__(self, keys: list[str], order: list[tuple[str, str]], marker: str = QUIT_TOKEN):
        self.keys, self.order, self.marker = keys, [name for name, _ in order], marker
        self.fields = _fields(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ended = handle.getValueState("ended", f"yes boolean{self.fields}")

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        ended, *last = self.ended.get() or (False,)
        if ended:  # what comes after the end is of no interest, in any order
            return
        batch = _sorted(rows, self.order)
        last = _follows(batch, self.order, last)
        found = np.flatnonzero((batch["tok"] == self.marker).to_numpy())
        self.ended.update((len(found) > 0, *last))
        kept = batch.iloc[: found[0]] if len(found) else batch
        if len(kept):
            yield kept[self.keys + self.order + ["tok"]]


class Vocabulary(StatefulProcessor):
    """Emits the words it stores; keeps (word -> count, place) since the last clear.

    One map entry per word: a batch touches the words it brings, not the list.
    """

    def __init__(self, keys: list[str], order: list[tuple[str, str]]):
        self.keys, self.order = keys, [name for name, _ in order]
        self.fields = _fields(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.words = handle.getMapState("wc", "word string", "count bigint, pos bigint")
        self.size = handle.getValueState("size", f"n bigint{self.fields}")

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        batch = _sorted(rows, self.order)
        clearing = (batch["word"] == CLEAR_WORDS_TOKEN).to_numpy()
        size, *last = self.size.get() or (0,)
        last = _follows(batch, self.order, last)
        # The list counts as filled by an earlier word, or as empty, at the start.
        run = _sums_since(clearing.astype(np.int64), ~clearing, 0)
        filled = np.logical_or.accumulate(~clearing) | (size > 0)
        clears = clearing & ((run % 2 == 1) == filled)
        live = batch["word"]
        if clears.any():
            self.words.clear()
            size = 0
            live = live.iloc[np.flatnonzero(clears)[-1] + 1 :]
        for word, count in live.groupby(live, sort=False).size().items():
            before, pos = self.words.getValue((word,)) or (0, size)
            if not before:
                size += 1
            self.words.updateValue((word,), (before + int(count), pos))
        self.size.update((size, *last))
        stored = batch.loc[~clears, self.keys + self.order + ["word"]]
        if len(stored):
            yield stored
