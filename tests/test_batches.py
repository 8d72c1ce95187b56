"""Streams of heavy keys as batch jobs, state changes, starts from saved state."""

import pytest
from model import Sums
from model import run as modelled
from pyspark.errors import StreamingQueryException

from tidemark.operators import keyed
from tidemark.plans import measure
from tidemark.session import child_names, path_exists
from tidemark.streaming import operators as streams
from tidemark.streaming import run, state
from tidemark.streaming.batches import HeavySums

SCHEMA = "key string, seq bigint, n bigint"
BATCHES = [
    [("a", 1, 5), ("a", 2, 7), ("b", 3, 1), (None, 4, 2)],
    [("a", 5, -1), ("a", 6, 4), (None, 7, 3), ("c", 8, -1)],
    [("a", 9, -2), ("b", 10, -1), ("a", 11, 1), ("c", 12, 9)],
]
ROWS = [row for batch in BATCHES for row in batch]


def running_sums(rows):
    models = modelled(Sums, rows)
    return [(key, seq, total) for key, m in models.items() for seq, _, total in m.out]


def published_states(rows):
    """The rows of a snapshot."""
    out = set()
    for key, m in modelled(Sums, rows).items():
        held, total = bool(m.items), sum(m.items)
        out.add((keyed.VALUE_STATE, key, None, None, total, True))
        out |= {(keyed.LIST_STATE, key, i, None, n, True) for i, n in enumerate(m.items)}
        if not held:
            out.add((keyed.LIST_STATE, key, None, None, None, False))
        entry = key or ""  # as text, where a null leaves nothing
        out.add((keyed.MAP_STATE, key, None, entry if held else None, total if held else None, held))
        out.add((keyed.REDUCING_STATE, key, None, None, total if held else None, held))
        out.add((keyed.KEYED_STATE, key, None, None, m.latest, m.latest is not None))
    return out


def feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(SCHEMA).parquet(folder)


def feed_all(spark, sums, tmp_path, batches=BATCHES):
    for batch in batches:
        stream = feed(spark, f"{tmp_path}/in", batch)
        run.run_available(sums.writer(stream), f"{tmp_path}/checkpoint")


@pytest.mark.parametrize("parts", [1, 4])
def test_sums_and_states_equal_the_loop(spark, tmp_path, collected, parts):
    sums = HeavySums(f"{tmp_path}/out", min_parts=parts)
    feed_all(spark, sums, tmp_path)
    got = {tuple(r) for r in sums.emitted(spark).select("key", "seq", "total").collect()}
    assert got == set(running_sums(ROWS))
    assert {tuple(r) for r in sums.snapshot(spark).collect()} == published_states(ROWS)


def test_a_batch_that_failed_half_way_counts_once(spark, tmp_path, monkeypatch):
    """The rows of the second batch are written, its state is not; then it runs again."""
    sums = HeavySums(f"{tmp_path}/out", min_parts=2)
    feed_all(spark, sums, tmp_path, BATCHES[:1])
    whole = HeavySums._state_after

    def fails(*args):
        raise RuntimeError("lost between rows and state")

    monkeypatch.setattr(HeavySums, "_state_after", fails)
    with pytest.raises(StreamingQueryException, match="lost between rows and state"):
        feed_all(spark, sums, tmp_path, BATCHES[1:2])
    assert path_exists(spark, f"{tmp_path}/out/rows/batch=1/_SUCCESS")
    assert sums.last_batch(spark) == 0
    first = {tuple(r) for r in sums.emitted(spark).select("key", "seq", "total").collect()}
    assert first == set(running_sums(BATCHES[0]))  # half a batch is not seen
    monkeypatch.setattr(HeavySums, "_state_after", whole)
    feed_all(spark, sums, tmp_path, BATCHES[2:])
    rows = [tuple(r) for r in sums.emitted(spark).select("key", "seq", "total").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == set(running_sums(ROWS))
    assert {tuple(r) for r in sums.snapshot(spark).collect()} == published_states(ROWS)


def test_a_committed_batch_is_passed_over(spark, tmp_path):
    sums = HeavySums(f"{tmp_path}/out")
    feed_all(spark, sums, tmp_path, BATCHES[:2])
    before = sorted(map(tuple, sums.state(spark).collect()), key=repr)
    sums.work(spark.createDataFrame([("a", 100, 50)], SCHEMA), 1)
    assert sorted(map(tuple, sums.state(spark).collect()), key=repr) == before


def test_old_states_are_removed(spark, tmp_path):
    sums = HeavySums(f"{tmp_path}/out")
    feed_all(spark, sums, tmp_path, [[("a", i, i)] for i in range(1, 6)])
    assert sorted(child_names(spark, f"{tmp_path}/out/state")) == ["batch=3", "batch=4"]


def test_a_batch_out_of_order_fails(spark, tmp_path):
    sums = HeavySums(f"{tmp_path}/out")
    with pytest.raises(StreamingQueryException, match="out of order"):
        feed_all(spark, sums, tmp_path, [BATCHES[0], [("a", 2, 1)]])


def test_final_states_neither_sort_nor_use_windows(spark, table):
    numbers = table(ROWS, SCHEMA)
    layout = measure(numbers, "key", "seq")
    for query in (keyed.value_state, keyed.map_state, keyed.reducing_state, keyed.keyed_latest):
        plan = query(numbers, layout)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Sort" not in plan and "BroadcastHashJoin" in plan


def test_many_keys_are_hashed_not_broadcast(spark, table, monkeypatch):
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", 2)
    numbers = table(ROWS, SCHEMA)
    states = keyed.value_state(numbers, measure(numbers, "key", "seq"))
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
    assert {tuple(r) for r in states.collect()} == {(k, v) for s, k, _, _, v, _ in published_states(ROWS) if s == keyed.VALUE_STATE}


def test_states_of_streams_that_end_with_clears(spark, table):
    rows = [("a", 1, 3), ("a", 2, -1), ("a", 3, 4), ("a", 4, 5), ("a", 5, -1), ("a", 6, -1), ("b", 7, -1), (None, 8, 6)]
    numbers = table(rows, SCHEMA)
    snapshot = keyed.state_snapshot(numbers, measure(numbers, "key", "seq"))
    assert {tuple(r) for r in snapshot.collect()} == published_states(rows)


# --- changes, saved state -------------------------------------------------------


def streamed(spark, tmp_path, name, batches, **options):
    checkpoint = f"{tmp_path}/{name}"
    for batch in batches:
        numbers = feed(spark, f"{tmp_path}/{name}-in", batch)
        run.run_available(run.to_state(streams.resettable_sum(numbers, **options), "append"), checkpoint)
    return checkpoint


def test_changes_tell_what_each_batch_did(spark, tmp_path):
    given = [[r for r in batch if r[0]] for batch in BATCHES]
    checkpoint = streamed(spark, tmp_path, "sums", given)
    values = state.changes(spark, checkpoint, keyed.VALUE_STATE).select("batch", "key", "value", "size").collect()
    assert {tuple(r) for r in values} == {
        (0, "a", 12, 2), (0, "b", 1, 1), (1, "a", 4, 1), (1, "c", 0, 0), (2, "a", 3, 3), (2, "b", 0, 0), (2, "c", 9, 1),
    }
    second = state.changes(spark, checkpoint, keyed.KEYED_STATE, 1, 1).select("batch", "key", "value").collect()
    assert {tuple(r) for r in second} == {(1, "a", 4)}
    reduced = state.changes(spark, checkpoint, keyed.REDUCING_STATE, 2).select("key", "change").collect()
    assert ("b", "delete") in {tuple(r) for r in reduced}


def test_a_new_stream_goes_on_from_saved_state(spark, tmp_path):
    given = [[r for r in batch if r[0]] for batch in BATCHES]
    old = streamed(spark, tmp_path, "old", given[:2])
    saved = state.saved_sums(spark, old)
    new = streamed(spark, tmp_path, "new", given[2:], initial=saved)
    rows = [r for batch in given for r in batch]
    assert {tuple(r) for r in state.snapshot(spark, new).collect()} == published_states(rows)


def test_a_new_stream_checks_the_saved_order(spark, tmp_path):
    saved = state.saved_sums(spark, streamed(spark, tmp_path, "old", [[("a", 5, 1)]]))
    with pytest.raises(StreamingQueryException, match="out of order"):
        streamed(spark, tmp_path, "new", [[("a", 4, 1)]], initial=saved)


def test_folders_of_unknown_masters_are_not_local(spark, monkeypatch):
    from tidemark.session import scratch_folder

    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session(), "x")
