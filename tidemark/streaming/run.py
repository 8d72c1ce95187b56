"""Starting streams: checkpoints, triggers and state storage.

A checkpoint folder outlives its query: starting the same query on it again
goes on where the last committed batch ended.  Sources here are replayable
files and the file sink commits a batch once, so every row counts exactly once
through failures and restarts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# State on local disk with uploads of changes only, so that a batch costs what
# it changes and not what the state holds.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Fixed value: the checkpoint interval where none is asked for.
INTERVAL = "60 seconds"
ALL_ROWS = (1 << 31) - 64
#: Seconds between looks at a running query; it has fewer than 100 batches in that time.
LOOK_SECONDS = 1


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """The state settings while a query starts, which copies them; then as before."""
    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def to_table(stream: DataFrame, path: str) -> DataStreamWriter:
    """Appends every output row to a parquet folder."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", path)


def to_state(stream: DataFrame, mode: str = "update") -> DataStreamWriter:
    """Drops the output: the state in the checkpoint is the result."""
    return stream.writeStream.format("noop").outputMode(mode)


def to_console(stream: DataFrame, mode: str = "update") -> DataStreamWriter:
    """Prints every row of every batch, in full."""
    console = stream.writeStream.format("console").option("truncate", False)
    return console.option("numRows", ALL_ROWS).outputMode(mode)


def start(writer: DataStreamWriter, checkpoint: str, interval: str = INTERVAL) -> StreamingQuery:
    """Run for good, with one batch, and so one checkpoint, per interval."""
    writer = writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval)
    with state_settings(writer._spark):  # the stream's own session, which need not be the active one
        query = writer.start()
        # The query copies the settings in its own thread after start() returns, so they
        # stay until its first batch has run.
        while not query.recentProgress and not query.awaitTermination(LOOK_SECONDS):
            pass
        return query


def _dropped(query: StreamingQuery, seen: dict[int, int]) -> None:
    """Adds the rows that each batch known to the query has dropped as late."""
    for progress in query.recentProgress:
        dropped = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        if dropped:  # a batch may report more than once
            seen[progress.batchId] = max(seen.get(progress.batchId, 0), dropped)


def run_available(
    writer: DataStreamWriter, checkpoint: str, until: Callable[[], bool] | None = None
) -> None:
    """Work off what the source holds now, in batches, and return.

    With `until`, the query is stopped once that holds.  Fails if the watermark dropped
    rows as late in any batch: choose a longer delay then, or keep those rows
    (`inputs.CountedWindows`).
    """
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # A query remembers its last 100 batches, so it is asked while it runs.
    seen: dict[int, int] = {}
    # The query copies the settings in its own thread after start() returns: they stay until it ends.
    with state_settings(writer._spark):  # the stream's own session, which need not be the active one
        query = writer.start()
        while not query.awaitTermination(LOOK_SECONDS):
            _dropped(query, seen)
            if until and until():
                query.stop()
    _dropped(query, seen)
    late = sum(seen.values())
    if late:
        raise ValueError(f"{late} rows came later than the watermark's delay and were dropped")


#: Rows of a part, which bounds a key's share of a batch.
PART_ROWS = 1 << 22


def even_cuts(
    rows: DataFrame, order: str, part_rows: int = PART_ROWS, least: int = 1
) -> list[int]:
    """Places in the order that part `rows` into about equal parts, `least` at least."""
    count = rows.count()
    parts = max(least, -(-count // part_rows))
    if not count or parts < 2:
        return []
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    # The error of a place is a small part of a part.
    cuts = rows.agg(F.percentile_approx(order, shares, 20 * parts)).first()[0]
    return sorted(set(cuts))


def run_in_order(
    writer: Callable[[DataFrame], DataStreamWriter],
    rows: DataFrame,
    order: str,
    cuts: Sequence[int],
    folder: str,
    checkpoint: str,
) -> None:
    """Feed a table to a stateful stream in its order, however its files interleave.

    The rows up to each cut, and those behind the last, are put into `folder`, a new one,
    and worked off by a start of the stream on `checkpoint`: one micro-batch and
    one restart per part.  Rows without an order value come first.
    """
    spark = rows.sparkSession
    place, low = F.col(order), None
    for high in [*cuts, None]:
        part = rows
        if low is not None:
            part = part.filter(place > low)
        if high is not None:
            below = place <= high
            part = part.filter(below if low is not None else below | place.isNull())
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        run_available(writer(stream), checkpoint)
        low = high
