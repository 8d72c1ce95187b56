"""A keyed table that a stream keeps by upserts, and that answers for single keys.

The keys are dealt by hash to a fixed number of slots.  A batch is reduced to its latest row
per key, meets the rows of the slots that it touches, and writes those slots anew; the
others stay in the folder of the batch that wrote them last.  The mark of a batch tells
for every slot which batch that is.  Readers take the folders that the last mark names,
so they see one whole batch while the next is under way.

A lookup reads the files of one slot, and of those only the row groups whose Parquet Bloom
filters and bounds admit the key.  Choose `slots` so that the keys of one fit a task.

The latest row is that with the greatest `order`, wherever it stood, so a batch that is
worked off twice, or out of turn, leaves the same table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.plans.layout import names
from tidemark.session import child_names, path_exists, remove_path
from tidemark.streaming.commit import KEPT, MARK, Committed

SLOTS = 256
SLOT = "__slot"


@dataclass(frozen=True)
class KeyedTable(Committed):
    """Latest row per key of a stream (keys, order, ...), below `folder` in shared storage.

    Null keys are a key of their own.  A row whose order is null counts as older than all.
    """

    folder: str
    keys: str | Sequence[str] = "key"
    order: str | Sequence[str] = "seq"
    slots: int = SLOTS

    def _slot(self, *keys: Column) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.slots)).cast("int")

    def _latest(self, rows: DataFrame) -> DataFrame:
        """One row per key.  Equal places go to the greatest of the other columns."""
        keys = list(names(self.keys))
        place = [*names(self.order), *[c for c in rows.columns if c not in (*keys, *names(self.order))]]
        top = rows.groupBy(*keys).agg(F.max(F.struct(*place)).alias("top"))
        return top.select(*keys, "top.*").select(*rows.columns)

    def _work(self, rows: DataFrame, batch: int) -> DataFrame:
        spark, keys = rows.sparkSession, list(names(self.keys))
        held = self._held(spark, batch - 1) if batch else {}
        new = self._latest(rows).withColumn(SLOT, self._slot(*map(F.col, keys)))
        new = self._write(new, "new", batch)
        touched = sorted(r[0] for r in new.select(SLOT).distinct().collect())  # `slots` at most
        before = [self._rows_path(held[slot], slot) for slot in touched if slot in held]
        merged = new
        if before:
            old = spark.read.schema(new.drop(SLOT).schema).parquet(*before)
            merged = self._latest(old.unionByName(new.drop(SLOT)))
            merged = merged.withColumn(SLOT, self._slot(*map(F.col, keys)))
        writer = merged.repartition(SLOT).sortWithinPartitions(SLOT, *keys).write.mode("overwrite")
        for key in keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.partitionBy(SLOT).parquet(self._path("rows", batch))
        remove_path(spark, self._path("new", batch))
        places = {**held, **dict.fromkeys(touched, batch)}
        kept = rows.drop(SLOT).schema.json()
        return spark.createDataFrame(
            [(-1, batch, kept), *[(slot, at, "") for slot, at in places.items()]], "slot int, at bigint, schema string"
        )

    def _held(self, spark: SparkSession, batch: int) -> dict[int, int]:
        """The batch that wrote each slot last; one entry per slot at most."""
        return {r["slot"]: r["at"] for r in self.mark(spark, batch).filter("slot >= 0").collect()}

    def _forget(self, spark: SparkSession, batch: int) -> None:
        """Slot folders that none of the kept marks names."""
        marks = range(max(batch - KEPT + 1, 0), batch + 1)
        needed = {
            (at, slot)
            for kept in marks
            if path_exists(spark, self._path(MARK, kept))
            for slot, at in self._held(spark, kept).items()
        }
        for name in child_names(spark, f"{self.folder}/rows"):
            at = int(name.removeprefix("batch="))
            if at in marks:
                continue
            slots = [int(s.split("=")[1]) for s in child_names(spark, f"{self.folder}/rows/{name}") if "=" in s]
            gone = [slot for slot in slots if (at, slot) not in needed]
            if len(gone) == len(slots):
                remove_path(spark, self._path("rows", at))
                continue
            for slot in gone:
                remove_path(spark, self._rows_path(at, slot))

    def _rows_path(self, batch: int, slot: int) -> str:
        return f"{self._path('rows', batch)}/{SLOT}={slot}"

    # --- readers ---

    def _read(self, spark: SparkSession, paths: list[str], batch: int) -> DataFrame:
        stored = self.mark(spark, batch).filter("slot < 0").first()["schema"]
        schema = StructType.fromJson(json.loads(stored))
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def table(self, spark: SparkSession) -> DataFrame:
        """All rows, as the last committed batch left them."""
        batch = self.last_batch(spark)
        paths = [self._rows_path(at, slot) for slot, at in self._held(spark, batch).items()]
        return self._read(spark, paths, batch)

    def lookup(self, spark: SparkSession, key: object) -> DataFrame:
        """The row of one key, or none, from the files of its slot alone.

        `key` is a value, or a tuple for several key columns.
        """
        parts, batch = key if isinstance(key, tuple) else (key,), self.last_batch(spark)
        kinds = {f.name: f.dataType for f in self._read(spark, [], batch).schema.fields}
        given = {k: F.lit(p).cast(kinds[k]) for k, p in zip(names(self.keys), parts, strict=True)}
        slot = spark.range(1).select(self._slot(*given.values())).first()[0]
        at = self._held(spark, batch).get(slot)
        rows = self._read(spark, [] if at is None else [self._rows_path(at, slot)], batch)
        for part, (name, value) in zip(parts, given.items(), strict=True):
            # A plain comparison, which reaches the Bloom filters; nulls have none.
            rows = rows.filter(F.col(name).isNull() if part is None else F.col(name) == value)
        return rows
