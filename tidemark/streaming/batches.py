"""Sums of streams whose keys outgrow a task: each micro-batch is worked off as a batch job.

A stateful processor gets all rows that a key has in a micro-batch in one task.  Where a
key holds a large part of the stream, as with one constant key, that task is the whole
batch.  Here a micro-batch goes through the ordered scan instead, which cuts heavy keys
into chunks, and the state of the keys is a table that every batch writes anew.

Each batch writes its rows first and then its state, both to folders of its own number.
The state's `_SUCCESS` file, which Spark puts there last, commits the batch.  A batch that
failed half way is written over when the stream runs it again, and one that was committed
is passed over, so every row counts once.  Readers see committed batches only.

Batches must arrive in order: a row that does not lie behind the last one of its key fails
the query.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators import incremental, keyed
from tidemark.plans import Layout, measure
from tidemark.plans.layout import GROUP_ROWS, names
from tidemark.session import child_names, path_exists, remove_path

#: States of the last batches that stay; older ones are removed.
KEPT_STATES = 2


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys, null ones too."""
    equal = [left[k].eqNullSafe(right[k]) for k in keys]
    return reduce(Column.__and__, equal, F.lit(True))


@dataclass(frozen=True)
class HeavySums:
    """Resettable sums of a stream (keys, order, n), below `folder` in shared storage.

    group_rows, min_parts: as in `measure`; how heavy a key must be to be cut.
    """

    folder: str
    keys: str | Sequence[str] = "key"
    order: str | Sequence[str] = "seq"
    group_rows: int = GROUP_ROWS
    min_parts: int = 1

    def writer(self, numbers: DataFrame) -> DataStreamWriter:
        """Hand it to `run_available` or `start` with a checkpoint of its own."""
        rows = numbers.select(*names(self.keys), *names(self.order), "n")
        return rows.writeStream.foreachBatch(self.work)

    # --- one batch ---

    def work(self, numbers: DataFrame, batch: int) -> None:
        spark = numbers.sparkSession
        if self._is_committed(spark, batch):
            return
        before = self._state_of(spark, batch - 1) if batch else None
        numbers = numbers.persist()
        try:
            self._check_order(numbers, before)
            layout = measure(numbers, self.keys, self.order, self.group_rows, self.min_parts)
            scanned = incremental.resume_sums(numbers, before, layout)
            scanned.write.mode("overwrite").parquet(f"{self.folder}/rows/batch={batch}")
        finally:
            numbers.unpersist()
        scanned = spark.read.schema(scanned.schema).parquet(f"{self.folder}/rows/batch={batch}")
        state = self._state_after(scanned, before, layout)
        state.write.mode("overwrite").parquet(f"{self.folder}/state/batch={batch}")
        remove_path(spark, f"{self.folder}/state/batch={batch - KEPT_STATES}")

    def _check_order(self, numbers: DataFrame, before: DataFrame | None) -> None:
        if before is None:
            return
        keys = list(names(self.keys))
        first = numbers.groupBy(*keys).agg(F.min(self._position()).alias("first"))
        wrong = first.join(before, same_keys(first, before, keys)).filter(F.col("first") <= F.col("at"))
        row = wrong.select("first", "at").first()
        if row:
            raise ValueError(f"batch out of order: {row['first']} after {row['at']}")

    def _position(self) -> Column:
        return Layout(names(self.keys), names(self.order)).position()

    def _state_after(self, scanned: DataFrame, before: DataFrame | None, layout: Layout) -> DataFrame:
        """(keys, total, size, latest, cleared, at): the last two are places in the order."""
        keys, new = list(layout.keys), ~F.col(incremental.SEED)
        position = layout.position()
        places = scanned.groupBy(*keys).agg(
            F.max(F.when(new & keyed.is_clear(), position)).alias("cleared"),
            F.max(F.when(new, position)).alias("at"),
        )
        sums = incremental.state_after(scanned, layout)
        state = sums.join(places, same_keys(sums, places, keys)).select(
            *[sums[k] for k in keys], "total", "size", "latest", "cleared", "at"
        )
        if before is None:
            return state
        old = before.select(*keys, F.col("cleared").alias("old_cleared"), F.col("at").alias("old_at"))
        return state.join(old, same_keys(state, old, keys), "left").select(
            *[state[k] for k in keys],
            "total",
            "size",
            "latest",
            F.coalesce("cleared", "old_cleared").alias("cleared"),
            F.coalesce("at", "old_at").alias("at"),
        )

    # --- what is committed ---

    def _is_committed(self, spark: SparkSession, batch: int) -> bool:
        return path_exists(spark, f"{self.folder}/state/batch={batch}/_SUCCESS")

    def _state_of(self, spark: SparkSession, batch: int) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/state/batch={batch}")

    def last_batch(self, spark: SparkSession) -> int:
        """The last committed batch."""
        found = [int(name.removeprefix("batch=")) for name in child_names(spark, f"{self.folder}/state")]
        found = [batch for batch in found if self._is_committed(spark, batch)]
        if not found:
            raise ValueError(f"no batch is committed below {self.folder}")
        return max(found)

    def state(self, spark: SparkSession) -> DataFrame:
        """(keys, total, size, latest, cleared, at) after the last committed batch."""
        return self._state_of(spark, self.last_batch(spark))

    def emitted(self, spark: SparkSession) -> DataFrame:
        """(keys, order, n, total, size, batch) of all numbers; `size` is the place since the last clear."""
        rows = spark.read.parquet(f"{self.folder}/rows").filter(F.col("batch") <= self.last_batch(spark))
        rows = rows.filter(~F.col(incremental.SEED) & ~keyed.is_clear())
        return rows.select(*names(self.keys), *names(self.order), "n", "total", "size", "batch")

    def value_state(self, spark: SparkSession) -> DataFrame:
        """Current sums; 0 right after a clear: (keys, value)."""
        return self.state(spark).select(*names(self.keys), F.col("total").alias("value"))

    def list_state(self, spark: SparkSession) -> DataFrame:
        """Numbers since the last clear: (keys, pos, n)."""
        keys, rows = list(names(self.keys)), self.emitted(spark)
        ends = self.state(spark).filter("size > 0").select(*keys, "cleared")
        live = rows.join(ends, same_keys(rows, ends, keys))
        live = live.filter(F.col("cleared").isNull() | (self._position() > F.col("cleared")))
        return live.select(*[rows[k] for k in keys], (F.col("size") - 1).alias("pos"), "n")

    def snapshot(self, spark: SparkSession) -> DataFrame:
        """All five states of every key: (state_name, keys, pos, map_key, value, found)."""
        keys, held = list(names(self.keys)), F.col("size") > 0
        layout = Layout(tuple(keys), names(self.order))
        sums = self.state(spark).select(
            *keys, F.when(held, F.col("total")).alias("sum"), F.col("latest").alias("last")
        )
        return keyed.published(sums, self.list_state(spark), layout)
