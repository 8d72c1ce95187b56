"""Streams that end as a whole, and windows that keep what came too late.

Both work a micro-batch off as a batch job and commit it by its mark (`streaming.commit`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.tokens import QUIT_TOKEN
from tidemark.plans import Layout
from tidemark.plans.layout import names
from tidemark.session import child_names, remove_path
from tidemark.streaming.commit import KEPT, Committed
from tidemark.streaming.run import run_available


@dataclass(frozen=True)
class QuitAll(Committed):
    """Rows of a stream before the first marker token of any key, which ends all of it.

    Batches must arrive in order; one that does not lie behind those before it fails the
    query.  What comes behind the marker, in its batch or later, is not emitted, and once
    a batch holds the marker no later one is read, also after a restart.
    """

    folder: str
    order: str | Sequence[str] = "seq"
    tok: str = "tok"
    marker: str = QUIT_TOKEN

    def _work(self, rows: DataFrame, batch: int) -> DataFrame:
        spark = rows.sparkSession
        before = self.mark(spark, batch - 1) if batch else None
        last = before.first() if before else None
        if last and last["ended"] is not None:
            return before
        layout = Layout((), names(self.order))
        place = layout.position()
        # One row: where the marker stands first, and the ends of the batch.
        found = rows.agg(
            F.min(F.when(F.col(self.tok) == self.marker, place)).alias("ended"),
            F.min(place).alias("first"),
            F.max(place).alias("at"),
        )
        found = self._write(found, "ends", batch)
        ends = found.first()
        if last and ends["first"] is not None and last["at"] is not None and ends["first"] <= last["at"]:
            raise ValueError(f"batch out of order: {ends['first']} after {last['at']}")
        stays = F.col("__ended").isNull() | (place < F.col("__ended"))
        end = found.select(F.col("ended").alias("__ended"))  # one row
        self._write(rows.crossJoin(end).filter(stays).drop("__ended"), "rows", batch)
        remove_path(spark, self._path("ends", batch - KEPT))
        if last and ends["at"] is None:
            return before  # an empty batch
        return found.drop("first")

    def ended(self, spark: SparkSession) -> bool:
        """Whether a committed batch held the marker."""
        if not child_names(spark, f"{self.folder}/mark"):
            return False
        return self.mark(spark, self.last_batch(spark)).first()["ended"] is not None

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Works off what the source holds, up to the marker; then starts no more."""
        spark = stream.sparkSession
        if not self.ended(spark):
            run_available(self.writer(stream), checkpoint, until=lambda: self.ended(spark))

    def emitted(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.parquet(f"{self.folder}/rows")
        return rows.filter(F.col("batch") <= self.last_batch(spark)).drop("batch")


@dataclass(frozen=True)
class CountedWindows(Committed):
    """Counts per word and tumbling window of event time; rows that come too late are kept.

    After a batch the watermark is the latest time seen less `delay`.  Windows that it has
    passed are closed; a later row of such a window, or one without a time, goes to
    `late` as it came.  So the counts of closed and open windows and the late rows add up
    to all rows.
    """

    folder: str
    delay: str
    word: str = "word"
    ts: str = "ts"
    width: str = "5 seconds"

    def _work(self, rows: DataFrame, batch: int) -> DataFrame:
        spark = rows.sparkSession
        # From the stored mark, so that a batch that runs again is parted alike.
        micros = self.mark(spark, batch - 1).first()["passed"] if batch else None
        time = F.col(self.ts).cast("timestamp")
        window, closes = F.window(time, self.width), F.col("__window.end")
        passed = F.timestamp_micros(F.lit(micros).cast("bigint"))
        # Windows leave out rows without a time.
        timed, late = rows.withColumn("__window", window), rows.filter(F.col(self.ts).isNull())
        if micros is not None:
            late = late.unionByName(timed.filter(closes <= passed).drop("__window"))
            timed = timed.filter(closes > passed)
        self._write(late, "late", batch)
        counted = timed.groupBy(F.col("__window").alias("window"), self.word)
        counted = counted.agg(F.count("*").alias("count"), F.max(time).alias("latest"))
        if batch:
            counted = spark.read.schema(counted.schema).parquet(self._path("open", batch - 1)).unionByName(counted)
            counted = counted.groupBy("window", self.word).agg(
                F.sum("count").alias("count"), F.max("latest").alias("latest")
            )
        merged = self._write(counted, "merged", batch)
        newest = F.unix_micros(F.max("latest") - F.expr(f"INTERVAL {self.delay}"))
        mark = merged.agg(F.greatest(newest, F.lit(micros).cast("bigint")).alias("passed"))
        mark = self._write(mark, "passed", batch)
        # Null where no row has had a time yet: then there is no window either.
        now = F.timestamp_micros(F.lit(mark.first()["passed"]).cast("bigint"))
        done = F.coalesce(F.col("window.end") <= now, F.lit(False))
        self._write(merged.filter(done).drop("latest"), "closed", batch)
        self._write(merged.filter(~done), "open", batch)
        return mark

    def _forget(self, spark: SparkSession, batch: int) -> None:
        for table in ("merged", "passed", "open"):
            remove_path(spark, self._path(table, batch - KEPT))

    def _committed(self, spark: SparkSession, table: str) -> DataFrame:
        rows = spark.read.parquet(f"{self.folder}/{table}")
        return rows.filter(F.col("batch") <= self.last_batch(spark)).drop("batch")

    def closed(self, spark: SparkSession) -> DataFrame:
        """(window, word, count) of the windows that the watermark has passed."""
        return self._committed(spark, "closed")

    def still_open(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self._path("open", self.last_batch(spark))).drop("latest")

    def late(self, spark: SparkSession) -> DataFrame:
        """The rows that came after their window had closed, and those without a time."""
        return self._committed(spark, "late")
