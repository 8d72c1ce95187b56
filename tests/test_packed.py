"""Sums of streams take a key's rows packed into one, and send its state writes together."""

from __future__ import annotations

import datetime
import io

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkRuntimeError
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.streaming import operators as streams
from tidemark.streaming import processors, run, state

SCHEMA = "key bigint, seq bigint, n bigint"


def batch(*rows):
    keys, seqs, numbers = zip(*rows, strict=True)
    return pa.record_batch({"key": pa.array(keys, pa.int64()), "seq": seqs, "n": numbers})


def lists(batches):
    return [(r["key"], sorted(zip(r["seq"], r["n"], strict=True))) for b in batches for r in b.to_pylist()]


def test_rows_of_a_key_become_one():
    given = [batch((1, 3, 7), (None, 0, 5), (2, 1, 6)), batch((None, 4, -1), (1, 2, 8))]
    got = lists(processors.packed(iter(given), ["key"]))
    assert sorted(got, key=str) == [(1, [(2, 8), (3, 7)]), (2, [(1, 6)]), (None, [(0, 5), (4, -1)])]
    assert not list(processors.packed(iter([]), ["key"]))


def test_few_rows_are_held_while_packing(monkeypatch):
    monkeypatch.setattr(processors, "PACK_ROWS", 2)
    given = [batch((1, i, i)) for i in range(5)]
    assert lists(processors.packed(iter(given), ["key"])) == [
        (1, [(0, 0), (1, 1)]), (1, [(2, 2), (3, 3)]), (1, [(4, 4)]),
    ]


def test_packed_rows_are_put_in_order():
    rows = [Row(key=1, seq=[5, 1], n=[50, 10]), Row(key=1, seq=[3], n=[30])]
    seq, n = processors._in_order(iter(rows), ["seq"], "n")
    assert seq.dtype == n.dtype == np.int64
    assert (seq.tolist(), n.tolist()) == ([1, 3, 5], [10, 30, 50])
    rows = [Row(at=["b", None, "a"], pos=[0, 0, 1], n=[1, 2, 3])]
    at, pos, n = processors._in_order(iter(rows), ["at", "pos"], "n")
    assert (at.tolist(), pos.tolist(), n.tolist()) == (["a", "b", None], [1, 0, 0], [3, 1, 2])


def test_the_state_gets_packed_rows(spark, tmp_path):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path))
    plan = streams.resettable_sum(stream)._jdf.queryExecution().analyzed().toString()
    assert plan.index("TransformWithState") < plan.index("MapInArrow")  # printed top down


class Client:
    """Takes messages as Spark's client does; answers as told, and only what was flushed."""

    def __init__(self, *answers):
        self.answers, self.sockfile, self.flushes = list(answers), io.BytesIO(), 0
        self.sockfile.flush = self.flushed

    def flushed(self):
        self.flushes += 1

    def _send_proto_message(self, message):
        self.sockfile.write(message)
        self.sockfile.flush()

    def _receive_proto_message(self):
        assert self.flushes
        return self.answers.pop(0)

    def write(self, message):
        self._send_proto_message(message)
        assert self._receive_proto_message()[0] == 0


class Handle:
    def __init__(self, client=None):
        self._statefulProcessorApiClient = client


def test_writes_are_sent_together():
    client = Client((0, "", b""), (0, "", b""))
    with processors._sent_together(Handle(client)):
        client.write(b"one")
        client.write(b"three")
    sent = b"".join(n.to_bytes(4) + len(m).to_bytes(4) + m for n, m in ((0, b"one"), (0, b"three")))
    assert client.sockfile.getvalue() == sent and client.flushes == 1 and not client.answers
    client.answers.append((0, "", b""))
    client.write(b"alone")
    assert client.flushes == 2 and not client.answers


def test_a_write_that_fails_is_raised():
    client = Client((0, "", b""), (1, "no space", b""), (0, "", b""))
    with pytest.raises(PySparkRuntimeError, match="no space"), processors._sent_together(Handle(client)):
        for message in (b"a", b"b", b"c"):
            client.write(message)
    assert not client.answers
    with processors._sent_together(Handle()):  # another client: each write by itself
        pass


def feed(spark, tmp_path, batches, schema, **options):
    folder, out, checkpoint = (f"{tmp_path}/{name}" for name in ("in", "out", "cp"))
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
        sums = streams.resettable_sum(spark.readStream.schema(schema).parquet(folder), **options)
        run.run_available(run.to_table(sums, out), checkpoint)
    return spark.read.parquet(out), checkpoint


def test_rows_without_a_key_are_one_key(spark, tmp_path, collected):
    batches = [
        [(None, 0, 5), (1, 1, 2), (None, 2, 6), (2, 3, 1)],
        [(None, 4, 7), (1, 5, -1), (None, 6, 1), (2, 7, 3)],
    ]
    rows, checkpoint = feed(spark, tmp_path, batches, SCHEMA)
    assert collected(rows, "seq", "key", "total") == [
        (0, None, 5), (1, 1, 2), (2, None, 11), (3, 2, 1), (4, None, 18), (6, None, 19), (7, 2, 4),
    ]
    held = state.snapshot(spark, checkpoint).filter(F.col("key").isNull() & (F.col("state_name") != "list-query"))
    assert collected(held, "state_name", "map_key", "value", "found") == [
        ("keyed-query", None, 19, True), ("map-query", "", 19, True),
        ("reduce-query", None, 19, True), ("value-query", None, 19, True),
    ]


def test_an_order_of_timestamps_goes_on(spark, tmp_path, collected):
    def at(second):
        return datetime.datetime(2024, 1, 1, 0, 0, second)

    schema = "key bigint, at timestamp, pos int, n bigint"
    batches = [[(1, at(2), 1, 6), (1, at(1), 0, 5)], [(1, at(3), 0, 7), (1, at(2), 2, 1)]]
    rows, _ = feed(spark, tmp_path, batches, schema, order=["at", "pos"])
    assert collected(rows, "at", "pos", "total") == [
        (at(1), 0, 5), (at(2), 1, 11), (at(2), 2, 12), (at(3), 0, 19),
    ]
