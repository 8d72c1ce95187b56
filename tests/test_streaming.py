import datetime

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from model import Sums, Words, number_stream, run, word_stream
from pyspark.sql import functions as F

from tidemark.functions import guard_forbidden, parse_marked
from tidemark.operators import counts, tokens
from tidemark.sources import text
from tidemark.streaming import operators as streams
from tidemark.streaming import state
from tidemark.streaming.processors import SegmentedList, _sums_since
from tidemark.streaming.run import (
    even_cuts,
    run_available,
    run_in_order,
    start,
    to_console,
    to_state,
    to_table,
)

SCHEMA = "key bigint, seq bigint, n bigint"


@pytest.fixture
def source(spark, tmp_path):
    """A folder to drop batches in, and its stream with one file per batch."""

    class Source:
        def __init__(self):
            self.folder, self.files = tmp_path / "in", 0
            self.folder.mkdir()
            self.checkpoint, self.out = str(tmp_path / "cp"), str(tmp_path / "out")

        def drop(self, rows, schema=SCHEMA):
            part = tmp_path / f"part{self.files}"
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(part))
            [file] = part.glob("*.parquet")
            target = self.folder / f"{self.files:04}.parquet"
            target.write_bytes(file.read_bytes())
            self.files += 1

        def stream(self, schema=SCHEMA):
            reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            return reader.parquet(str(self.folder))

        def output(self, *columns):
            return sorted(tuple(r) for r in spark.read.parquet(self.out).select(*columns).collect())

    return Source()


def parts(rows, n):
    rows = sorted(rows, key=lambda r: r[1])
    size = -(-len(rows) // n)
    # Within a batch the rows come in no order.
    return [rows[i : i + size][::-1] for i in range(0, len(rows), size)]


def test_sums_over_batches_equal_the_loop(spark, source, collected):
    rows = number_stream(21, keys=12, length=30, hot=200)
    for part in parts(rows, 3):
        source.drop(part)
    run_available(to_table(streams.resettable_sum(source.stream()), source.out), source.checkpoint)
    models = run(Sums, rows)
    assert source.output("key", "seq", "total") == sorted(
        (k, seq, total) for k, m in models.items() for seq, _, total in m.out
    )
    cp = source.checkpoint
    live = {k: m.items for k, m in models.items()}
    assert dict(state.value_state(spark, cp).collect()) == {k: sum(v) for k, v in live.items()}
    assert collected(state.list_state(spark, cp), "key", "pos", "n") == sorted(
        (k, i, n) for k, v in live.items() for i, n in enumerate(v)
    )
    held = {k: sum(v) for k, v in live.items() if v}
    assert dict(state.reducing_state(spark, cp).collect()) == held
    assert collected(state.map_state(spark, cp), "key", "map_key", "value") == sorted(
        (k, str(k), v) for k, v in held.items()
    )
    assert dict(state.keyed_latest(spark, cp).collect()) == {
        k: m.latest for k, m in models.items() if m.latest is not None
    }
    names = {r.name for r in state.state_names(spark, cp).collect()}
    assert names == set(state.VARIABLES.values())


def test_fault_and_restart(spark, source):
    """A batch fails at 155; without the guard the query goes on where it was."""
    key = "k string, seq bigint, tok string"

    def query(guard):
        stream = source.stream(key)
        n = parse_marked(F.col("tok"))
        numbers = stream.select(F.col("k").alias("key"), "seq", (guard(n) if guard else n).alias("n"))
        return to_table(streams.resettable_sum(numbers), source.out)

    for at, batch in enumerate((["5", "7"], ["clear", "4"], ["155", "1"])):
        source.drop([("a", 2 * at + i, t) for i, t in enumerate(batch)], key)
    with pytest.raises(Exception, match="not valid"):
        run_available(query(guard_forbidden), source.checkpoint)
    assert source.output("total") == [(4,), (5,), (12,)]
    run_available(query(None), source.checkpoint)
    assert source.output("seq", "total") == [(0, 5), (1, 12), (3, 4), (4, 159), (5, 160)]
    run_available(query(None), source.checkpoint)
    assert len(source.output("total")) == 5
    # States as of every batch are still there.
    past = [state.value_state(spark, source.checkpoint, b).first().value for b in (0, 1, 2)]
    assert past == [12, 4, 160]


@pytest.mark.parametrize("operator", [streams.resettable_sum, streams.running_average])
def test_batches_out_of_order_fail(source, operator):
    source.drop([(1, 5, 1), (1, 7, 1)])
    source.drop([(1, 6, 1), (1, 8, 1)])
    with pytest.raises(Exception, match="batch out of order"):
        run_available(to_table(operator(source.stream()), source.out), source.checkpoint)


def test_lookup(spark, source):
    key = "key string, seq bigint, n bigint"
    source.drop([("a", 0, 1), ("a", 1, 2), ("b", 2, 5), ("b", 3, -1)], key)
    run_available(to_table(streams.resettable_sum(source.stream(key)), source.out), source.checkpoint)

    def ask(k, **options):
        rows = state.lookup(spark, source.checkpoint, k, **options).collect()
        return sorted((r.state_name, r.pos, r.map_key, r.value, r.found) for r in rows)

    assert ask("a") == [
        ("keyed-query", None, None, 3, True),
        ("list-query", 0, None, 1, True),
        ("list-query", 1, None, 2, True),
        ("map-query", None, "a", 3, True),
        ("reduce-query", None, None, 3, True),
        ("value-query", None, None, 3, True),
    ]
    assert ask("b") == [
        ("keyed-query", None, None, 5, True),
        ("list-query", None, None, None, False),
        ("map-query", None, None, None, False),
        ("reduce-query", None, None, None, False),
        ("value-query", None, None, 0, True),
    ]
    assert {found for *_, found in ask("nobody")} == {False}
    assert {found for *_, found in ask(" A ")} == {False}
    assert ask(" A ", normalise=True) == ask("a")
    assert ask("a", states="value-query") == [("value-query", None, None, 3, True)]


def test_lookup_of_a_state_not_kept(spark, source):
    source.drop([(1, 0, 1)])
    stream = streams.resettable_sum(source.stream(), keep_list=False)
    run_available(to_table(stream, source.out), source.checkpoint)
    rows = {r.state_name: r.found for r in state.lookup(spark, source.checkpoint, 1).collect()}
    assert rows == {name: name != "list-query" for name in state.VARIABLES}


def test_running_average_over_batches(source):
    rows = number_stream(22, keys=8, length=20, hot=100)
    for part in parts(rows, 3):
        source.drop(part)
    run_available(to_table(streams.running_average(source.stream()), source.out), source.checkpoint)
    assert source.output("key", "seq", "avg") == sorted(
        (k, *row) for k, m in run(Sums, rows).items() for row in m.averages
    )


def test_vocabulary_over_batches(spark, source, collected):
    schema = "key bigint, seq bigint, word string"
    rows = word_stream(23, keys=12, length=25, hot=150)
    for part in parts(rows, 4):
        source.drop(part, schema)
    run_available(to_table(streams.vocabulary(source.stream(schema)), source.out), source.checkpoint)
    models = run(Words, rows)
    assert source.output("key", "seq", "word") == sorted(
        (k, *row) for k, m in models.items() for row in m.out
    )
    assert collected(state.vocabulary(spark, source.checkpoint), "key", "pos", "word", "count") == (
        sorted((k, i, w, c) for k, m in models.items() for i, (c, w) in enumerate(m.entries))
    )


def test_tumbling_count_over_batches(spark, source, collected):
    schema = "word string, seq bigint"
    rows = [("ab"[i % 2], i // 3) for i in range(60)]
    for part in parts(rows, 3):
        source.drop(part, schema)
    stream = source.stream(schema).select("word", F.timestamp_seconds("seq").alias("ts"))
    windows = streams.tumbling_count(stream, delay="1 second")
    run_available(to_table(windows, source.out), source.checkpoint)
    closed = spark.read.parquet(source.out).select("window.start", "word", "count")
    still_open = state.read_state(spark, source.checkpoint).select(
        "key.window.start", "key.word", "value.count"
    )
    batch = spark.createDataFrame(rows, schema).select("word", F.timestamp_seconds("seq").alias("ts"))
    assert 0 < still_open.count() < 4
    assert collected(closed.unionByName(still_open)) == collected(
        counts.tumbling_count(batch).select("window_start", "word", "count")
    )


def test_words_of_a_text_stream(spark, tmp_path):
    folder, cp = tmp_path / "text", str(tmp_path / "cp")
    folder.mkdir()
    (folder / "a.txt").write_bytes(b"I am alpha beta alpha beta\r\nok ok ok")
    words = tokens.words(text.stream_lines(spark, str(folder), files_per_batch=1))
    run_available(to_state(streams.word_count(words)), cp)
    (folder / "b.txt").write_text("ok\n\nclear")
    run_available(to_state(streams.word_count(words)), cp)
    got = dict(state.read_state(spark, cp).select("key.word", "value.count").collect())
    assert got == {"I": 1, "am": 1, "alpha": 2, "beta": 2, "ok": 4, "": 1, "clear": 1}

    def count_of(word, **options):
        return tuple(state.lookup_aggregate(spark, cp, word, **options).first())

    assert count_of("ok") == (4, True) and count_of("ok", batch=0) == (3, True)
    assert count_of("OK ") == (None, False) and count_of("OK ", normalise=True) == (4, True)
    assert count_of("I") == (1, True) and count_of("I", normalise=True) == (None, False)


def test_numbers_of_an_ordered_text_stream(spark, tmp_path):
    folder = tmp_path / "text"
    folder.mkdir()
    (folder / "a.txt").write_text("1 2\nx 3\n\nclear 4\n5")
    lines = text.stream_ordered_lines(spark, str(folder))
    order = ["modified", "file", "line", "pos"]
    numbers = tokens.numbers(tokens.tokens(lines)).withColumn("key", F.lit("statekey"))
    stream = streams.resettable_sum(numbers, order=order)
    run_available(to_table(stream, str(tmp_path / "out")), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("line", "pos").collect()
    assert [(r.line, r.pos, r.total) for r in got] == [
        (0, 0, 1), (0, 1, 3), (1, 1, 6), (3, 1, 4), (4, 0, 9),
    ]


def test_start_runs_on_an_interval(source):
    source.drop([(1, 0, 1)])
    words = source.stream().select(F.col("key").alias("word"))
    query = start(to_console(streams.word_count(words)), source.checkpoint, interval="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and query.lastProgress is not None
    finally:
        query.stop()


@given(
    st.lists(st.tuples(st.integers(-(2**40), 2**40), st.booleans()), min_size=1, max_size=40),
    st.integers(-(2**40), 2**40),
)
def test_sums_since(rows, carried):
    values, restart = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    want, total = [], carried
    for value, again in rows:
        total = value if again else total + value
        want.append(total)
    assert _sums_since(values, restart, carried).tolist() == want


def test_sum_past_64_bits_fails():
    with pytest.raises(OverflowError):
        _sums_since(np.array([2**62]), np.array([False]), 2**62)


def test_segmented_list():
    class Map(dict):
        updateValue = dict.__setitem__

        def iterator(self):
            return iter(self.items())

    class Handle:
        def getMapState(self, *_):
            return Map()

    items = SegmentedList(Handle(), "name", "bigint")
    items.add_all(0, list(range(20000)))
    items.add_all(20000, [1, 1])
    assert items.get() == [*range(20000), 1, 1]
    items.replace([7])
    assert items.get() == [7]
    items.clear()
    assert items.get() == []


def test_sum_up_to_the_last_of_64_bits():
    top = 2**63 - 1
    sums = _sums_since(np.array([top, -top, top, 0]), np.zeros(4, bool), 0)
    assert sums.tolist() == [top, 0, top, top]
    low = _sums_since(np.array([-(2**62)]), np.zeros(1, bool), -(2**62))
    assert low.tolist() == [-(2**63)]
    with pytest.raises(OverflowError):
        _sums_since(np.array([1]), np.zeros(1, bool), top)


def test_late_rows_fail_the_run(spark, source):
    schema = "word string, ts timestamp_ntz"
    for second in ("00:00:30", "00:00:31", "00:00:01", "00:01:30"):
        at = datetime.datetime.fromisoformat(f"2024-01-01 {second}")
        source.drop([("a", at)], schema)
    windows = streams.tumbling_count(source.stream(schema), delay="0 seconds")
    with pytest.raises(ValueError, match="later than"):
        run_available(to_table(windows, source.out), source.checkpoint)


def test_lookup_fails_on_a_missing_checkpoint(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)state|exist|checkpoint"):
        state.lookup(spark, f"{tmp_path}/nowhere", 1).collect()


def test_a_table_of_interleaved_files_is_fed_in_order(spark, source, tmp_path):
    """Twenty files, each with rows from all over the order."""
    rows = number_stream(24, keys=5, length=20, hot=100)
    spark.createDataFrame(rows, SCHEMA).repartition(20).write.parquet(str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    cuts = even_cuts(table, "seq", least=3)
    assert len(cuts) == 2
    folder = str(tmp_path / "arrived")
    run_in_order(
        lambda s: to_table(streams.resettable_sum(s), source.out), table, "seq", cuts, folder, source.checkpoint
    )
    assert source.output("key", "seq", "total") == sorted(
        (k, seq, total) for k, m in run(Sums, rows).items() for seq, _, total in m.out
    )


def test_take_until_over_batches(source):
    schema = "key bigint, seq bigint, tok string"
    source.drop([(1, 0, "a"), (2, 1, "quit"), (1, 2, None)], schema)
    source.drop([(1, 4, "quit"), (1, 3, "b"), (2, 5, "c"), (1, 6, "d")], schema)
    source.drop([(1, 7, "e"), (3, 8, "f")], schema)
    stream = streams.take_until(source.stream(schema))
    run_available(to_table(stream, source.out), source.checkpoint)
    assert sorted(source.output("seq", "key")) == [(0, 1), (2, 1), (3, 1), (8, 3)]


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def test_state_settings_hold_while_the_stream_runs(spark, source):
    """The stream copies the session's settings in its own thread, after start() returns."""
    source.drop([(1, 0, 1)])
    seen = []

    def batch(rows, _):
        seen.append(spark.conf.get(PROVIDER))

    run_available(source.stream().writeStream.foreachBatch(batch), source.checkpoint)
    assert seen and all(name.endswith("RocksDBStateStoreProvider") for name in seen)
    offsets = (source.folder.parent / "cp" / "offsets" / "0").read_text()
    assert "RocksDBStateStoreProvider" in offsets
    assert not spark.conf.get(PROVIDER).endswith("RocksDBStateStoreProvider")
