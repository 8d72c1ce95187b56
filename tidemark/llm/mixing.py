"""Mixing sources to target weights by weighted fair queueing.

Every source's documents stand in a shuffled order, and the whole order comes up to
`epochs` times.  Copy c of a document finishes at the virtual time

    (c * source_size + words of the source up to and with it) / target of the source

so a source with twice the target runs twice as fast.  All copies are sorted by that
time, over all sources, and the mix is the longest run from the start whose words fit
the budget.  As the targets add up to the budget, the cut lies near time 1, where
each source has given its target.

Running sums are taken in two steps, per (source, bucket of the shuffled order) and
over the small table of buckets, so a source of any size spreads over many tasks;
the global order likewise, by buckets of virtual time.

Defined results: a null text has size 0, a null source is a source of its own, and
comes last.  Repeated rows are documents of their own.  A document of size 0 costs
nothing and is in the mix when its time comes.  A source of size 0 has target 0 and
gives nothing.  An empty table gives an empty mix.  Other columns are carried along,
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import written
from tidemark.llm.words import WORD

WEIGHTS = (1, 2, 3)
EPOCHS = 3
#: Parts of a source's shuffled order that are summed on their own.
ORDER_BUCKETS = 4096
#: Parts of the virtual time up to 1, and parts of each doubling beyond it.
TIME_BUCKETS = 1 << 15
LATE_BUCKETS = 1 << 10


@dataclass(frozen=True)
class Cut:
    """The last copy of the mix: its place in the global order; None for an empty mix."""

    finish: float
    source_no: int
    place: int
    doc_id: int | None
    copy: int


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, share: float = 1.0, most: int = EPOCHS) -> DataFrame:
    """(source, source_no, source_size, weight, target) from rows of (source, size).

    Weights repeat 1, 2, 3 by code point of the source.  Targets are the level at which
    sources fill up in proportion to their weights, each to `most` times its size at
    most, until `share` of all words is placed.  One row per source, so the windows
    here run over a small table.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    by_level = Window.orderBy("full_at", "source_no")
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(by_name) - 1
    ranked = per_source.withColumn("source_no", number).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("source_no") % 3) + 1)
    )
    filled = ranked.withColumns(
        {
            "cap": (F.col("source_size") * most).cast("double"),
            "full_at": F.col("source_size") * most / F.col("weight"),
            "budget": F.sum("source_size").over(everything) * F.lit(float(share)),
        }
    ).withColumns(
        {
            "earlier": F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)),
            "weights": F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    level = (F.col("budget") - F.coalesce("earlier", F.lit(0.0))) / F.col("weights")
    reaches = level <= F.col("full_at")  # the first source that is not full sets the level
    place = F.when(reaches, F.struct("full_at", "source_no"))
    reached = F.min_by(F.when(reaches, level), place).over(everything)
    target = F.least("cap", F.coalesce(reached * F.col("weight"), F.col("cap")))
    return filled.withColumn("target", target).select(
        "source", "source_no", "source_size", "weight", "target", "budget"
    )


def schedule(
    docs: DataFrame, sources: DataFrame, seed: int = 0, epochs: int = EPOCHS
) -> DataFrame:
    """(row, doc_id, size, source_no, source_size, target, budget, place, finishes).

    `docs` has row, doc_id, mark, source and size; `finishes` are the virtual times of the
    document's copies, none where the target is 0.  `mark`, a hash of the text, spreads
    documents that share an id, such as a null one, over the order.
    """
    known = docs.join(
        sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))
    ).withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "mark"))
    # Unsigned order of the hash is not needed: any fixed order is a shuffle.
    known = known.withColumn("bucket", F.shiftright("place", 64 - ORDER_BUCKETS.bit_length() + 1))
    keys = ["source_no", "bucket"]
    parts = known.groupBy(*keys).agg(F.sum("size").alias("part"))
    up_to = Window.partitionBy("source_no").orderBy("bucket")
    parts = parts.select(*keys, (F.sum("part").over(up_to) - F.col("part")).alias("earlier"))
    within = Window.partitionBy(*keys).orderBy("place", "doc_id", "size")
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = known.withColumn("inside", F.sum("size").over(within)).join(parts, keys)
    given = F.col("earlier") + F.col("inside")
    finishes = F.array(
        *[(F.lit(c) * F.col("source_size") + given) / F.col("target") for c in range(epochs)]
    )
    empty = F.array().cast("array<double>")
    return placed.withColumn("finishes", F.when(F.col("target") > 0, finishes).otherwise(empty))


def _time_bucket(finish: Column) -> Column:
    late = F.lit(TIME_BUCKETS) + F.floor(F.log2(finish) * LATE_BUCKETS)
    return F.when(finish < 1, F.floor(finish * TIME_BUCKETS)).otherwise(late)


def _copies(scheduled: DataFrame) -> DataFrame:
    return scheduled.select("*", F.posexplode("finishes").alias("copy", "finish"))


def find_cut(scheduled: DataFrame) -> Cut | None:
    """The last copy within the budget; two rows reach the driver."""
    copies = _copies(scheduled).withColumn("time", _time_bucket(F.col("finish")))
    totals = copies.groupBy("time").agg(F.sum("size").alias("n"), F.first("budget").alias("budget"))
    running = Window.orderBy("time")  # a bounded number of buckets
    totals = totals.withColumn("with", F.sum("n").over(running))
    fits = F.col("with") <= F.floor("budget")
    edge = totals.agg(
        F.min(F.when(~fits, F.col("time"))).alias("time"),
        F.min_by(F.when(~fits, F.col("with") - F.col("n")), F.when(~fits, F.col("time"))).alias(
            "earlier"
        ),
        F.max("time").alias("last"),
        F.first(F.floor("budget")).alias("budget"),
    ).first()
    if edge["last"] is None:
        return None
    order = ["finish", "source_no", "place", "doc_id", "copy"]
    if edge["time"] is None:
        last = copies.agg(F.max(F.struct(*order)).alias("key")).first()["key"]
        return Cut(*last)
    by_order = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = copies.filter(F.col("time") == edge["time"])
    inside = inside.withColumn("so_far", F.sum("size").over(by_order) + edge["earlier"])
    last = inside.filter(F.col("so_far") <= edge["budget"])
    last = last.agg(F.max(F.struct(*order)).alias("key")).first()["key"]
    if last is None:
        earlier = copies.filter(F.col("time") < edge["time"])
        last = earlier.agg(F.max(F.struct(*order)).alias("key")).first()["key"]
    return Cut(*last) if last else None


def _taken(cut: Cut | None, finish: Column, copy: Column) -> Column:
    """Whether a copy is at the cut or before it."""
    if cut is None:
        return F.lit(False)
    id_type = "bigint"
    key = F.struct(
        finish, F.col("source_no"), F.col("place"), F.col("doc_id").cast(id_type), copy
    )
    last = F.struct(
        F.lit(cut.finish),
        F.lit(cut.source_no),
        F.lit(cut.place).cast("bigint"),
        F.lit(cut.doc_id).cast(id_type),
        F.lit(cut.copy),
    )
    return key <= last


def scheduled_mix(docs: DataFrame, share: float = 1.0, seed: int = 0) -> tuple[DataFrame, Cut | None]:
    """The schedule of all rows of `docs` (doc_id, text, source, ...) and its cut.

    The sizes are counted once and kept as a narrow table; the cut is found on it.
    """
    row, mark = F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("mark")
    given = docs.select(row, "doc_id", mark, "source", word_count().alias("size"))
    narrow = written(given.select("doc_id", "mark", "source", "size"), "mixing-sizes")
    sources = written(targets(narrow, share), "mixing-targets")
    flat = narrow.withColumn("row", F.lit(None).cast("string"))
    cut = find_cut(schedule(flat, sources, seed))
    return schedule(given, sources, seed), cut


def taken_words(docs: DataFrame, share: float = 1.0, seed: int = 0) -> DataFrame:
    """One row per document with the words of it that the mix takes, repeats counted."""
    scheduled, cut = scheduled_mix(docs.select("doc_id", "text", "source"), share, seed)
    copies = F.filter(
        F.transform("finishes", lambda x, i: F.struct(x.alias("finish"), i.alias("copy"))),
        lambda c: _taken(cut, c["finish"], c["copy"]),
    )
    return scheduled.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size(copies)).alias("taken"),
    )


def mix(docs: DataFrame, share: float = 1.0, seed: int = 0) -> DataFrame:
    """The mix itself: the columns of `docs`, a row per copy, in order of virtual time."""
    scheduled, cut = scheduled_mix(docs, share, seed)
    copies = _copies(scheduled).filter(_taken(cut, F.col("finish"), F.col("copy")))
    order = ["finish", "source_no", "place", "copy"]
    chosen = copies.select("row", *order).repartitionByRange(*order).sortWithinPartitions(*order)
    return chosen.select("row.*")
