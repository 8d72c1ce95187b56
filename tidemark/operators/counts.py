"""Counts per word: final, running, and per tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.tokens import counted
from tidemark.plans import Layout, Pass, ordered_scan


def word_count(stream: DataFrame, word: str = "word") -> DataFrame:
    """Occurrences of every word: (word, count).  Counted before the shuffle."""
    return stream.groupBy(word).agg(F.count("*").alias("count"))


def formatted(counts: DataFrame, word: str = "word", count: str = "count") -> DataFrame:
    """Count rows as one text column: (line)."""
    return counts.select(counted(F.col(word), F.col(count)).alias("line"))


def running_count(stream: DataFrame, layout: Layout) -> DataFrame:
    """Every occurrence with the number of times its word, the key, has come up so far."""
    return ordered_scan(stream, layout, Pass({"count": F.lit(1)}))


def tumbling_count(
    stream: DataFrame,
    word: str = "word",
    ts: str = "ts",
    n: str | None = None,
    width: str = "5 seconds",
) -> DataFrame:
    """Sum of `n` (of 1 where not given) per word and window: (window_start, word, count)."""
    amount = F.col(n) if n else F.lit(1)
    start = F.window(ts, width)["start"].alias("window_start")
    return stream.groupBy(start, F.col(word)).agg(F.sum(amount).cast("bigint").alias("count"))
