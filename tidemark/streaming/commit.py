"""Batch jobs of a stream that count once, by a marker that each batch puts last.

A micro-batch writes its tables to folders of its own number and the table `MARK`, of a
few rows, after all others.  The mark's `_SUCCESS` file commits the batch: one that failed
half way is written over when the stream runs it again, and a committed one is passed over.
Readers go by the last mark and so see whole batches only, also while the next one runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidemark.session import child_names, path_exists, remove_path

#: The table that is written last.
MARK = "mark"
#: Batches whose marks, and what only they need, stay; readers of older ones must be done.
KEPT = 2


class Committed:
    """What subclasses share; they define `_work`, which returns the rows of the mark."""

    folder: str

    def writer(self, stream: DataFrame) -> DataStreamWriter:
        """Hand it to `run_available` or `start` with a checkpoint of its own."""
        return stream.writeStream.foreachBatch(self.work)

    def work(self, rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        if path_exists(spark, f"{self._path(MARK, batch)}/_SUCCESS"):
            return
        mark = self._work(rows, batch)
        mark.coalesce(1).write.mode("overwrite").parquet(self._path(MARK, batch))
        remove_path(spark, self._path(MARK, batch - KEPT))
        self._forget(spark, batch)

    def _work(self, rows: DataFrame, batch: int) -> DataFrame:
        raise NotImplementedError

    def _forget(self, spark: SparkSession, batch: int) -> None:
        """Removes what no kept mark needs, once `batch` is committed."""

    def _path(self, table: str, batch: int) -> str:
        return f"{self.folder}/{table}/batch={batch}"

    def _write(self, rows: DataFrame, table: str, batch: int) -> DataFrame:
        """Writes a table of a batch, and reads it from there."""
        path = self._path(table, batch)
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def mark(self, spark: SparkSession, batch: int) -> DataFrame:
        return spark.read.parquet(self._path(MARK, batch))

    def last_batch(self, spark: SparkSession) -> int:
        """The last committed batch."""
        found = [int(name.removeprefix("batch=")) for name in child_names(spark, f"{self.folder}/{MARK}")]
        found = [batch for batch in found if path_exists(spark, f"{self._path(MARK, batch)}/_SUCCESS")]
        if not found:
            raise ValueError(f"no batch is committed below {self.folder}")
        return max(found)
