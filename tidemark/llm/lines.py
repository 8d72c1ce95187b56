"""Line dedup against sorted runs of line hashes that are kept in levels.

A line's key is the line without blanks at its ends, A-Z in lower case.  Keys that are
long enough and stand in two documents or more lose all their lines but those in the
smallest doc_id that holds them.

`Runs` holds the keys seen so far, each with the document that owns it: bucketed tables,
sorted by two 64-bit hashes.  Batches come in ascending order of doc_id.  Each one is
reduced to its distinct keys, merge-anti-joined with every run (bucket by bucket, so the
runs are not shuffled), and what is new becomes a run of level 0.  When `fan_out` runs
of a level are there, they become one run of the next level; a key is so rewritten once
per level, and a batch meets few runs however many came before.  A line stays where its
(key, document) stands in the run that its batch has added.

All of it is DataFrame functions.  Frequent lines are reduced before every shuffle; what
joins by key also joins by document, so a line that all documents hold spreads over the
tasks.

Defined results: a null or empty text is one empty line, which stays.  A null doc_id
counts as the largest (2**63 - 1).  Rows that share a doc_id are one document, null ones
as well: what one of them owns, all of them keep.  Repeated rows have the same result.
An empty table gives no rows; further columns are ignored.  Two keys are taken for equal
when both hashes agree, 128 bits together.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.store import written
from tidemark.session import scratch_folder

LEAST_CHARS = 10
#: Batches that a whole table is cut into, and runs of a level that become one.
BATCHES, FAN_OUT = 4, 2
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST_ID = (1 << 63) - 1
HASHES = ["h1", "h2"]


def key(line: Column) -> Column:
    """A line without blanks at its ends and with A-Z, no other letter, in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _documents(docs: DataFrame) -> DataFrame:
    """(doc, mark, text): rows that agree in doc and mark have the same text."""
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID))
    return docs.select(doc.alias("doc"), F.xxhash64(_text()).alias("mark"), _text().alias("text"))


def hashed_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(doc, mark, pos, h1, h2) of the lines whose keys have `least` code points or more."""
    lines = _documents(docs).select("doc", "mark", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # A generator, so that keys are made once and not again in the filter and each hash.
    keyed = lines.select("doc", "mark", "pos", F.explode(F.array(key(F.col("line")))).alias("key"))
    keyed = keyed.filter(F.char_length("key") >= least)
    return keyed.select(
        "doc", "mark", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


class Runs:
    """Keys seen so far with the documents that own them, in levels of sorted runs.

    `buckets` should be the number of shuffle partitions: batches then meet the runs
    without a further exchange.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan_out: int = FAN_OUT) -> None:
        self.spark, self.fan_out = spark, fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        path = scratch_folder(self.spark, "line-run")
        writer = rows.write.format("parquet").option("compression", "zstd").option("path", path)
        writer.bucketBy(self.buckets, *HASHES).sortBy(*HASHES).saveAsTable(name)
        return name

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, lines: DataFrame, more: bool = True) -> DataFrame:
        """Adds the keys of a batch; returns those that are new: (h1, h2, doc).

        `more` tells whether further batches follow; runs are merged only for those.
        """
        new = lines.groupBy(*HASHES).agg(F.min("doc").alias("doc"))
        for run in self.tables():
            new = new.join(run.select(*HASHES).hint("merge"), HASHES, "left_anti")
        name = self._write(new)
        self.levels[0].append(name)
        out = self.spark.table(name)
        if more:
            self._compact()
        return out

    def _compact(self) -> None:
        """Every full level becomes one run of the next; the runs share no key."""
        for i, level in enumerate(list(self.levels)):
            if len(self.levels[i]) < self.fan_out:
                break
            runs = [self.spark.table(name) for name in self.levels[i]]
            merged = runs[0]
            for run in runs[1:]:
                merged = merged.unionByName(run)
            # Grouped for its distribution by key only, which buckets have already.
            name = self._write(merged.groupBy(*HASHES).agg(F.min("doc").alias("doc")))
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(name)
            self.levels[i] = []


def dropped(lines: DataFrame, new: DataFrame) -> DataFrame:
    """(doc, mark, gone): places of the lines of a batch whose keys it has not added itself."""
    gone = lines.join(new, [*HASHES, "doc"], "left_anti")
    return gone.groupBy("doc", "mark").agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def _kept(text: Column, gone: Column) -> Column:
    """The lines outside the sorted places `gone`: the stretches between them, joined."""

    def stretches(lines: Column) -> Column:
        def stretch(i: Column) -> Column:
            begin = F.coalesce(F.get(gone, i - 1) + 1, F.lit(0))
            end = F.coalesce(F.get(gone, i), F.size(lines))
            return F.slice(lines, begin + 1, end - begin)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), stretch)), "\n")

    # One element, so that the text is split once and not for each stretch.
    return F.element_at(F.transform(F.array(F.split(text, "\n")), stretches), 1)


def ranges(lines: DataFrame, batches: int) -> list[tuple[int | None, int | None]]:
    """Ranges (above, up to) of doc with about as many lines each, in ascending order."""
    shares = [i / batches for i in range(1, batches)]
    cuts = lines.agg(F.percentile_approx("doc", shares or [0.5], 1000).alias("cuts")).first()["cuts"] or []
    edges = [None, *sorted(set(cuts)), None] if shares else [None, None]
    return list(zip(edges[:-1], edges[1:], strict=True))


def deduplicate(docs: DataFrame, least: int = LEAST_CHARS, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) for every row of `docs` (doc_id, text)."""
    lines = written(hashed_lines(docs, least), "lines")
    runs, gone = Runs(docs.sparkSession), None
    parts = ranges(lines, batches)
    for above, upto in parts:
        batch = lines
        if above is not None:
            batch = batch.filter(F.col("doc") > above)
        if upto is not None:
            batch = batch.filter(F.col("doc") <= upto)
        new = runs.add(batch, more=upto is not None)
        found = written(dropped(batch, new), "lines-dropped")
        gone = found if gone is None else gone.unionByName(found)
    rows = _documents(docs).join(gone, ["doc", "mark"], "left")
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(_kept(F.col("text"), F.col("gone")))
    return rows.select(
        F.nullif("doc", F.lit(LAST_ID)).alias("doc_id"),
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        kept.alias("kept"),
    )
