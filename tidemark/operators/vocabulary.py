"""The word list of a key: counted words in the order of their first arrival.

The clearing token empties a list that holds something; on an empty list it is
stored like any word.  So in a run of clearing tokens every second one clears:
the odd ones after another word, the even ones at the start of the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.tokens import CLEAR_WORDS_TOKEN
from tidemark.plans import Layout, Pass, in_order, ordered_scan
from tidemark.session import scratch_folder


def _mark_clears(rows, scan, word):
    """Adds `clears`: true where a clearing token empties the list."""
    clearing = F.col(word) == CLEAR_WORDS_TOKEN
    rows = scan(rows, Pass({"run": clearing.cast("bigint")}, restart=~clearing, seen="filled"))
    odd = F.col("run") % 2 == 1
    return rows.withColumn("clears", clearing & (odd == F.col("filled"))).drop("run", "filled")


def accepted_words(stream: DataFrame, layout: Layout, word: str = "word") -> DataFrame:
    """What the job emits: every word it stores, as it came: (keys, order, word)."""
    rows = stream.select(*layout.keys, *layout.order, word).filter(F.col(word).isNotNull())
    marked = in_order(rows, layout, lambda rows, scan: _mark_clears(rows, scan, word))
    return marked.filter(~F.col("clears")).drop("clears")


def vocabulary(stream: DataFrame, layout: Layout, word: str = "word") -> DataFrame:
    """Word list of every key since its last clear: (keys, pos, word, count), pos from 0."""

    def steps(rows, scan):
        marked = _mark_clears(rows, scan, word)
        return scan(marked, Pass(restart=F.col("clears"), seen="dead", descending=True))

    rows = stream.select(*layout.keys, *layout.order, word).filter(F.col(word).isNotNull())
    live = in_order(rows, layout, steps).filter(~F.col("dead"))
    entries = live.groupBy(*layout.keys, word).agg(
        F.count("*").alias("count"), F.min(layout.position()).alias("first")
    )
    if len(layout.order) > 1:
        first = [F.col("first")[c].alias(c) for c in layout.order]
    else:
        first = [F.col("first").alias(layout.order[0])]
    entries = entries.select(*layout.keys, word, "count", *first)
    if layout.heavy:
        entries = _written(entries)
    # A key has no more entries than tokens, so the layout fits them too.
    placed = ordered_scan(entries, layout, Pass({"place": F.lit(1)}), placed=True)
    return placed.select(*layout.keys, (F.col("place") - 1).alias("pos"), word, "count")


def _written(entries: DataFrame) -> DataFrame:
    """The entries from a table: a scan that splits keys reads its input three times."""
    spark = entries.sparkSession
    folder = scratch_folder(spark, "entries")
    entries.write.parquet(folder)
    return spark.read.schema(entries.schema).parquet(folder)
