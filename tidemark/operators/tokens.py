"""Lines to tokens, tokens to numbers, and the end-of-input marker."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.tokens import QUIT_TOKEN, parse_marked, split_tokens
from tidemark.plans import Layout


def words(lines: DataFrame, line: str = "value", word: str = "word") -> DataFrame:
    """One row per token of each line, without positions: (word)."""
    return lines.select(F.explode(split_tokens(F.col(line))).alias(word))


def tokens(lines: DataFrame, line: str = "value", pos: str = "pos", tok: str = "tok") -> DataFrame:
    """One row per token, with its position in the line in place of the line."""
    others = [c for c in lines.columns if c != line]
    return lines.select(*others, F.posexplode(split_tokens(F.col(line))).alias(pos, tok))


def numbers(stream: DataFrame, tok: str = "tok", n: str = "n") -> DataFrame:
    """Tokens that are integers or the clear token; the latter becomes -1."""
    others = [c for c in stream.columns if c != tok]
    parsed = stream.select(*others, parse_marked(F.col(tok)).alias(n))
    return parsed.filter(F.col(n).isNotNull())


def rejects(stream: DataFrame, tok: str = "tok") -> DataFrame:
    """Tokens that `numbers` leaves out, as they came."""
    return stream.filter(F.col(tok).isNotNull() & parse_marked(F.col(tok)).isNull())


def take_until(
    stream: DataFrame, layout: Layout, tok: str = "tok", marker: str = QUIT_TOKEN
) -> DataFrame:
    """Rows of each key before its first marker token.

    The first marker of each key is a minimum, reduced before its shuffle; only keys
    with a marker are in the joined table, and no rows are sorted for a window.
    """
    first = F.min(layout.position()).alias("ended")
    ends = stream.filter(F.col(tok) == marker).groupBy(*layout.keys).agg(first)
    before = F.col("ended").isNull() | (layout.position() < F.col("ended"))
    if not layout.keys:
        return stream.crossJoin(ends).filter(before).drop("ended")  # one row
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in layout.keys]
    ends = ends.withColumnsRenamed({k: f"__{k}" for k in layout.keys})
    found = stream.join(ends, reduce(Column.__and__, same), "left").filter(before)
    return found.select(*stream.columns)
