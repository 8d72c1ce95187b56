"""Streams worked off as committed batches: keyed tables, whole inputs that end, late rows."""

import datetime
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.session import child_names, path_exists
from tidemark.streaming import run
from tidemark.streaming.commit import Committed
from tidemark.streaming.inputs import CountedWindows, QuitAll
from tidemark.streaming.published import KeyedTable


def feed(spark, driver, tmp_path, batches, schema, runner=None):
    """Each batch as a file and a start of the stream."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        run.run_available(driver.writer(stream), f"{tmp_path}/checkpoint")


# --- keyed tables ------------------------------------------------------------

ROWS = "key string, seq bigint, total bigint"
UPSERTS = [
    [("a", 1, 10), ("b", 2, 20), (None, 3, 30), ("a", 4, 40)],
    [("c", 5, 50), ("b", 6, None)],
    [("a", 7, 70), ("d", 8, 80)],
]


def latest(batches):
    out = {}
    for key, seq, total in (row for batch in batches for row in batch):
        if key not in out or seq > out[key][0]:
            out[key] = (seq, total)
    return {(key, *row) for key, row in out.items()}


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_a_keyed_table_holds_the_latest_rows(spark, tmp_path):
    table = KeyedTable(f"{tmp_path}/out", slots=8)
    feed(spark, table, tmp_path, UPSERTS, ROWS)
    assert rows_of(table.table(spark)) == latest(UPSERTS)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    table = KeyedTable(f"{tmp_path}/out", slots=8)
    feed(spark, table, tmp_path, UPSERTS, ROWS)
    # As a driver that lost the record of its last batch would: under the same and a new number.
    table.work(spark.createDataFrame(UPSERTS[2], ROWS), 2)
    table.work(spark.createDataFrame(UPSERTS[2], ROWS), 3)
    assert rows_of(table.table(spark)) == latest(UPSERTS)


def test_a_batch_that_failed_is_not_seen_and_runs_again(spark, tmp_path, monkeypatch):
    table = KeyedTable(f"{tmp_path}/out", slots=4)
    feed(spark, table, tmp_path, UPSERTS[:2], ROWS)
    whole = KeyedTable._work

    def fails(self, rows, batch):
        whole(self, rows, batch)
        raise RuntimeError("lost before the mark")

    monkeypatch.setattr(KeyedTable, "_work", fails)
    with pytest.raises(StreamingQueryException, match="lost before the mark"):
        feed(spark, table, tmp_path, UPSERTS[2:], ROWS)
    assert path_exists(spark, f"{tmp_path}/out/rows/batch=2/_SUCCESS")
    assert rows_of(table.table(spark)) == latest(UPSERTS[:2])
    monkeypatch.setattr(KeyedTable, "_work", whole)
    feed(spark, table, tmp_path, [[("e", 9, 90)]], ROWS)
    assert rows_of(table.table(spark)) == latest([*UPSERTS, [("e", 9, 90)]])


def test_a_reader_keeps_its_batch_while_the_next_is_written(spark, tmp_path):
    table = KeyedTable(f"{tmp_path}/out", slots=4)
    feed(spark, table, tmp_path, UPSERTS[:2], ROWS)
    held = table.table(spark)
    feed(spark, table, tmp_path, UPSERTS[2:], ROWS)
    assert rows_of(held) == latest(UPSERTS[:2])


def test_a_lookup_reads_the_files_of_one_slot(spark, tmp_path):
    table = KeyedTable(f"{tmp_path}/out", slots=16)
    many = [(f"k{i}", i, i * i) for i in range(400)]
    feed(spark, table, tmp_path, [many[:300], many[300:], [("k7", 1000, 1)]], ROWS)
    found = table.lookup(spark, "k9")
    assert rows_of(found) == {("k9", 9, 81)}
    assert len(found.inputFiles()) == 1 < len(table.table(spark).inputFiles())
    assert rows_of(table.lookup(spark, "k7")) == {("k7", 1000, 1)}
    assert rows_of(table.lookup(spark, "no such key")) == set()
    assert rows_of(table.table(spark)) == latest([many, [("k7", 1000, 1)]])


def test_lookup_of_a_null_key_and_of_two_columns(spark, tmp_path):
    one = KeyedTable(f"{tmp_path}/one", slots=4)
    one.work(spark.createDataFrame(UPSERTS[0], ROWS), 0)
    assert rows_of(one.lookup(spark, None)) == {(None, 3, 30)}
    two = KeyedTable(f"{tmp_path}/two", keys=["key", "seq"], order="total", slots=4)
    two.work(spark.createDataFrame(UPSERTS[0], ROWS), 0)
    assert rows_of(two.lookup(spark, ("a", 4))) == {("a", 4, 40)}
    assert two.table(spark).count() == 4


def test_only_slots_that_a_mark_names_stay(spark, tmp_path):
    table = KeyedTable(f"{tmp_path}/out", slots=1)
    for i in range(4):
        table.work(spark.createDataFrame([("a", i, i)], ROWS), i)
    table.work(spark.createDataFrame([], ROWS), 4)  # an empty batch
    assert sorted(child_names(spark, f"{tmp_path}/out/mark")) == ["batch=3", "batch=4"]
    assert sorted(child_names(spark, f"{tmp_path}/out/rows")) == ["batch=3", "batch=4"]
    assert rows_of(table.table(spark)) == {("a", 3, 3)}


# --- the end of the whole input ----------------------------------------------

TOKS = "key string, seq bigint, tok string"
INPUT = [
    [("a", 1, "x"), ("b", 2, "y")],
    [("b", 5, "quit"), ("a", 3, "z"), ("a", 6, "w"), ("c", 4, None), ("c", 7, "quit")],
    [("a", 8, "v")],
]


def test_the_first_marker_ends_all_keys(spark, tmp_path):
    ending = QuitAll(f"{tmp_path}/out")
    feed(spark, ending, tmp_path, INPUT[:1], TOKS)
    assert not ending.ended(spark) and ending.emitted(spark).count() == 2
    feed(spark, ending, tmp_path, INPUT[1:], TOKS)
    assert ending.ended(spark)
    assert rows_of(ending.emitted(spark)) == {("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z"), ("c", 4, None)}
    # A restart neither reads nor emits.
    feed(spark, ending, tmp_path, [[("a", 9, "u")]], TOKS)
    assert sorted(child_names(spark, f"{tmp_path}/out/rows")) == ["batch=0", "batch=1"]
    assert ending.emitted(spark).count() == 4


def test_a_run_stops_at_the_marker(spark, tmp_path):
    ending = QuitAll(f"{tmp_path}/out")
    spark.createDataFrame(INPUT[1], TOKS).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(TOKS).parquet(f"{tmp_path}/in")
    ending.run(stream, f"{tmp_path}/checkpoint")
    before = ending.last_batch(spark)
    spark.createDataFrame(INPUT[2], TOKS).write.mode("append").parquet(f"{tmp_path}/in")
    ending.run(stream, f"{tmp_path}/checkpoint")
    assert ending.last_batch(spark) == before


def test_an_input_out_of_order_fails(spark, tmp_path):
    ending = QuitAll(f"{tmp_path}/out")
    with pytest.raises(StreamingQueryException, match="out of order"):
        feed(spark, ending, tmp_path, [INPUT[0], [("a", 2, "x")]], TOKS)


# --- windows and late rows ---------------------------------------------------

TIMES = "word string, ts timestamp, id bigint"


def at(second):
    return datetime.datetime(2024, 1, 1, 0, 0, second)


ARRIVALS = [
    [("a", at(1), 1), ("a", at(3), 2), ("b", at(12), 3), ("b", None, 4)],
    [("a", at(2), 5), ("b", at(11), 6), ("a", at(6), 7), (None, at(13), 8)],
    [],
    [("a", at(40), 9), ("b", at(14), 10)],
    [("b", at(14), 11), ("a", at(42), 12)],
]


def loop(batches, delay):
    """Counts by (window start, word) and the ids of late rows, one row after the other."""
    counts, late, passed = Counter(), set(), None
    for rows in batches:
        for word, ts, id_ in rows:
            start = ts and ts.second // 5 * 5
            if ts is None or (passed is not None and start + 5 <= passed):
                late.add(id_)
            else:
                counts[start, word] += 1
        times = [ts.second for _, ts, _ in rows if ts]
        if times:
            passed = max([max(times) - delay] + ([passed] if passed is not None else []))
    return counts, late, passed


@pytest.mark.parametrize("delay", [0, 6])
def test_windows_and_late_rows_are_all_rows(spark, tmp_path, delay):
    windows = CountedWindows(f"{tmp_path}/out", f"{delay} seconds")
    for batch, rows in enumerate(ARRIVALS):
        windows.work(spark.createDataFrame(rows, TIMES), batch)
        windows.work(spark.createDataFrame(rows, TIMES), batch)  # again, as after a lost record
    counts, late, passed = loop(ARRIVALS, delay)
    second = F.second("window.start")
    closed = {(s, w): n for s, w, n in windows.closed(spark).select(second, "word", "count").collect()}
    still = {(s, w): n for s, w, n in windows.still_open(spark).select(second, "word", "count").collect()}
    assert closed == {k: n for k, n in counts.items() if k[0] + 5 <= passed}
    assert still == {k: n for k, n in counts.items() if k[0] + 5 > passed}
    assert {r["id"] for r in windows.late(spark).collect()} == late


def test_windows_of_a_stream(spark, tmp_path):
    windows = CountedWindows(f"{tmp_path}/out", "0 seconds")
    feed(spark, windows, tmp_path, ARRIVALS[:2], TIMES)
    rows = sum(n for (n,) in windows.closed(spark).unionByName(windows.still_open(spark)).select("count").collect())
    assert rows + windows.late(spark).count() == 8


# --- what a query forgets ----------------------------------------------------


def progress(batch, *dropped):
    return SimpleNamespace(batchId=batch, stateOperators=[SimpleNamespace(numRowsDroppedByWatermark=d) for d in dropped])


def test_dropped_rows_of_forgotten_batches_count():
    """A query that remembers two batches at a time, looked at while it runs."""
    seen = {}
    for first in range(150):
        run._dropped(SimpleNamespace(recentProgress=[progress(first, 1 if first == 0 else 0), progress(first + 1, 0)]), seen)
    assert sum(seen.values()) == 1


def test_subclasses_must_work():
    with pytest.raises(NotImplementedError):
        Committed()._work(None, 0)
