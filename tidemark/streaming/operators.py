"""Streaming DataFrames for the main operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tidemark.functions.tokens import QUIT_TOKEN
from tidemark.operators.keyed import is_clear
from tidemark.plans.layout import names
from tidemark.streaming import processors
from tidemark.streaming.processors import (
    ResettableSum,
    RunningAverage,
    RunningCount,
    TakeUntil,
    Vocabulary,
)

# Executors get the processors with the query and need no copy of this package.
cloudpickle.register_pickle_by_value(processors)


def word_count(stream: DataFrame, word: str = "word") -> DataFrame:
    """Running count per word; the state holds (word) -> (count)."""
    return stream.groupBy(word).agg(F.count("*").alias("count"))


def tumbling_count(
    stream: DataFrame,
    word: str = "word",
    ts: str = "ts",
    width: str = "5 seconds",
    *,
    delay: str,
    n: str | None = None,
) -> DataFrame:
    """Sum of `n` (of 1 where not given) per word and window: (window, word, count), in UTC.

    Append mode emits a window once the watermark, `delay` behind the latest
    event, has passed it; the state holds the open windows only.  Rows later
    than that would be lost, so choose `delay` after the disorder of the source; there
    is no default, and `run_available` fails if rows were dropped.
    """
    added = [F.col(n).cast("bigint").alias(n)] if n else []
    timed = stream.select(F.col(ts).cast("timestamp").alias(ts), word, *added)
    windows = timed.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("window"), word)
    return windows.agg((F.sum(n) if n else F.count("*")).alias("count"))


def last_input(numbers: DataFrame, keys: str | Sequence[str], order: str = "seq") -> DataFrame:
    """Last number per key, clears left out; reduced before the shuffle."""
    given = numbers.filter(~is_clear())
    return given.groupBy(*names(keys)).agg(F.max_by("n", order).alias("value"))


def _apply(stream, processor, keys, order, columns, result, **options):
    keys, order = list(names(keys)), list(names(order))
    rows = stream.select(*keys, *order, *columns)
    kinds = dict(rows.dtypes)
    kept = [f for f in rows.schema.fields if f.name in (*keys, *order)]
    return rows.groupBy(*keys).transformWithStateInPandas(
        processor(keys, [(c, kinds[c]) for c in order], **options),
        StructType([*kept, result]),
        "Append",
        "None",
    )


def resettable_sum(
    numbers: DataFrame,
    keys: str | Sequence[str] = "key",
    order: str | Sequence[str] = "seq",
    keep_list: bool = True,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Each number with the sum since the last clear: (keys, order, total).

    `initial` is what an earlier stream has kept (`state.saved_sums`): a new stream, on a
    new checkpoint, goes on from it.
    """
    keys, order = list(names(keys)), list(names(order))
    rows = numbers.select(*keys, *order, "n")
    kinds, fields = dict(rows.dtypes), {field.name: field for field in rows.schema}

    def lists(*columns: str) -> StructType:
        kept = [fields[c] for c in keys]
        return StructType([*kept, *[StructField(c, ArrayType(fields[c].dataType)) for c in columns]])

    # State is kept key by key, which costs little next to handing over the rows one by one.
    packed = rows.repartition(*keys).mapInArrow(partial(processors.packed, keys=keys), lists(*order, "n"))
    sums = packed.groupBy(*keys).transformWithState(
        ResettableSum(keys, [(c, kinds[c]) for c in order], keep_list),
        lists(*order).add("total", ArrayType(LongType())),
        "Append",
        "None",
        initial.groupBy(*keys) if initial is not None else None,
    )
    return sums.select(*keys, F.inline(F.arrays_zip(*order, "total")))


def running_average(
    numbers: DataFrame, keys: str | Sequence[str] = "key", order: str | Sequence[str] = "seq"
) -> DataFrame:
    """Average since the last clear, from the second number on: (keys, order, avg)."""
    avg = StructField("avg", DoubleType())
    return _apply(numbers, RunningAverage, keys, order, ["n"], avg)


def running_count(
    stream: DataFrame, keys: str | Sequence[str] = "word", order: str | Sequence[str] = "seq"
) -> DataFrame:
    """Every occurrence with the number of times its word has come up: (keys, order, count)."""
    return _apply(stream, RunningCount, keys, order, [], StructField("count", LongType()))


def take_until(
    stream: DataFrame,
    keys: str | Sequence[str] = "key",
    order: str | Sequence[str] = "seq",
    marker: str = QUIT_TOKEN,
) -> DataFrame:
    """Rows of each key before its first marker token, in whichever batch that comes."""
    tok = StructField("tok", StringType())
    return _apply(stream, TakeUntil, keys, order, ["tok"], tok, marker=marker)


def vocabulary(
    stream: DataFrame, keys: str | Sequence[str] = "key", order: str | Sequence[str] = "seq"
) -> DataFrame:
    """Every stored word; the state holds the counted word list of each key.

    A null is no word, here and in batch.
    """
    word = StructField("word", StringType())
    return _apply(stream.filter(F.col("word").isNotNull()), Vocabulary, keys, order, ["word"], word)
