"""Benchmark decontamination by greedy string tiling.

A document is held against a test item by tiles: runs of tokens that both have, each
token in one tile at most, the longest first.  The share of the item's tokens that tiles
cover is its coverage.  Tiles may stand in any order, so an item whose sentences were
moved about is found as well.

A tile has at least `LEAST` tokens, so every token of one lies in a shared seed, a window
of that many tokens.  The scan of the documents looks each window up in a bitmap of the
items' seeds, whose size is fixed, and keeps only stretches of hits.  The seeds of those
are joined with the items' seeds, and each pair of document and item that shares one is
tiled on the kept stretches, which gives the same tiles as the whole text would.

Tokens are runs of letters and digits of the texts in lower case; they are compared by
64-bit hashes.

Defined results: null and empty texts are in no pair, nor are items shorter than a
tile.  Rows with equal doc_ids are judged together, by the highest coverage; so are rows
with equal item_ids.  A null doc_id is an id like any other.  Empty tables give no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.store import written

#: Tokens of the shortest tile, and the coverage from which an item counts as leaked.
LEAST = 5
COVERAGE = 0.5
#: The longest tile that is looked for at first; longer ones make the search start again.
FIRST_LENGTH = 20
BITMAP_BITS = 1 << 22
NULL_ID = -(1 << 63)


def tiles(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(place in item, place in text, length) of the tiles of two token sequences.

    `text` may hold zeros as marks between stretches; no tile crosses one.
    """
    free_item, free_text = item != 0, text != 0
    found, length = [], min(FIRST_LENGTH, max(len(item), least))
    while True:
        longest, matches = _matches(item, text, free_item, free_text, length)
        if longest > 2 * length:
            length = longest
            continue
        for _, i, j, size in sorted((-m[2], m[0], m[1], m[2]) for m in matches):
            # What an earlier tile took of a match is cut off; the rest may still do.
            while size >= length and not (free_item[i] and free_text[j]):
                i, j, size = i + 1, j + 1, size - 1
            taken = ~(free_item[i : i + size] & free_text[j : j + size])
            size = int(np.argmax(taken)) if taken.any() else size
            if size >= length:
                free_item[i : i + size] = free_text[j : j + size] = False
                found.append((i, j, size))
        if length <= least:
            return found
        length = max(least, length // 2)


def _matches(item, text, free_item, free_text, length):
    """Maximal matches of at least `length` free tokens, by Karp-Rabin; the longest size."""
    a, b = W.windows(item, length), W.windows(text, length)
    if not len(a) or not len(b):
        return 0, []

    def whole(free):
        return np.lib.stride_tricks.sliding_window_view(free, length).all(axis=1)

    at_item, at_text = np.flatnonzero(whole(free_item)), np.flatnonzero(whole(free_text))
    at_text = at_text[np.isin(b[at_text], a[at_item])]
    at_item = at_item[np.isin(a[at_item], b[at_text])]
    places: dict[int, list[int]] = {}
    for i in at_item.tolist():
        places.setdefault(int(a[i]), []).append(i)
    longest, matches, reached = 0, [], {}
    for j in at_text.tolist():
        for i in places[int(b[j])]:
            if reached.get(i - j, -1) > j:  # inside a match that was found before
                continue
            size = length
            while (
                i + size < len(item)
                and j + size < len(text)
                and item[i + size] == text[j + size]
                and free_item[i + size]
                and free_text[j + size]
            ):
                size += 1
            if (item[i : i + size] != text[j : j + size]).any():
                continue
            reached[i - j] = j + size - length + 1
            matches.append((i, j, size))
            longest = max(longest, size)
    return longest, matches


def _tokens(texts: pa.Array, hasher: W.Hasher) -> tuple[np.ndarray, np.ndarray]:
    words = W.split(texts, W.PUNCTUATION)
    hashes = hasher.words(words, lower=False)
    return np.where(hashes == 0, np.uint64(1), hashes), words.first


def _items(least: int):
    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher()
        for batch in batches:
            for part in W.slices(batch):
                tokens, first = _tokens(part.column("text"), hasher)
                start, row = W.window_rows(first, least)
                seeds = W.windows(tokens, least)[start]
                edges = np.searchsorted(row, np.arange(part.num_rows + 1))
                yield pa.record_batch(
                    {
                        "item": part.column("item"),
                        "tokens": pa.array(
                            [tokens[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()
                        ),
                        "seeds": pa.ListArray.from_arrays(
                            pa.array(edges, pa.int32()), pa.array(seeds.view(np.int64))
                        ),
                    }
                )

    return items


def _stretches(least: int, bitmap: np.ndarray):
    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc, tokens, seeds): for rows with hits, the tokens of hits, 0 between stretches."""
        hasher = W.Hasher()
        for batch in batches:
            for part in W.slices(batch):
                tokens, first = _tokens(part.column("text"), hasher)
                start, row = W.window_rows(first, least)
                seeds = W.windows(tokens, least)[start]
                bit = seeds & np.uint64(BITMAP_BITS - 1)
                hit = (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
                hit = np.flatnonzero(hit)
                start, row, seeds = start[hit], row[hit], seeds[hit]
                if not len(row):
                    continue
                rows, edges = np.unique(row, return_index=True)
                kept, lists = [], []
                for a, b in zip(edges, np.append(edges[1:], len(row)), strict=True):
                    use = np.unique(start[a:b, None] + np.arange(least)[None])
                    gap = np.flatnonzero(np.diff(use) > 1) + 1
                    kept.append(np.insert(tokens[use], gap, 0).tobytes())
                    lists.append(np.unique(seeds[a:b]).view(np.int64))
                yield pa.record_batch(
                    {
                        "doc": part.column("doc").take(pa.array(rows)),
                        "tokens": pa.array(kept, pa.binary()),
                        "seeds": pa.array(lists, pa.list_(pa.int64())),
                    }
                )

    return stretches


def _tiled(least: int):
    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered, size, count = [], [], []
            for item, text in zip(batch.column("item_tokens"), batch.column("tokens"), strict=True):
                item = np.frombuffer(item.as_py(), np.uint64)
                found = tiles(item, np.frombuffer(text.as_py(), np.uint64), least)
                covered.append(sum(t[2] for t in found))
                count.append(len(found))
                size.append(len(item))
            yield pa.record_batch(
                {
                    "doc": batch.column("doc"),
                    "item": batch.column("item"),
                    "item_tokens": pa.array(size, pa.int64()),
                    "covered_tokens": pa.array(covered, pa.int64()),
                    "tiles": pa.array(count, pa.int64()),
                }
            )

    return tiled


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Bits of all seeds; at most BITMAP_BITS / 64 rows reach the driver."""
    bit = F.col("seed").bitwiseAND(F.lit(BITMAP_BITS - 1))
    words = seeds.select(F.shiftright(bit, 6).alias("word"), F.pmod(bit, F.lit(64)).cast("int").alias("bit"))
    rows = words.groupBy("word").agg(F.collect_set("bit").alias("bits")).collect()
    bitmap = np.zeros(BITMAP_BITS // 8, np.uint8)
    for row in rows:
        for b in row["bits"]:
            bitmap[row["word"] * 8 + b // 8] |= 1 << (b % 8)
    return bitmap


def coverage(docs: DataFrame, items: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, item_id, item_tokens, covered_tokens, tiles, coverage) of pairs with a seed."""
    null = F.lit(NULL_ID)
    item = items.select(F.coalesce(F.col("item_id").cast("bigint"), null).alias("item"), F.lower("text").alias("text"))
    item = item.mapInArrow(_items(least), "item bigint, tokens binary, seeds array<bigint>")
    item = written(item, "tiling-items")
    seeds = item.select("item", F.explode("seeds").alias("seed")).distinct()
    given = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), null).alias("doc"), F.lower("text").alias("text"))
    columns = "doc bigint, tokens binary, seeds array<bigint>"
    hits = given.mapInArrow(_stretches(least, _bitmap(seeds)), columns)
    # Rows that share an id are told apart by their stretches, so each is tiled with its own items.
    hits = written(hits.withColumn("row", F.xxhash64("tokens")), "tiling-hits")
    pairs = hits.select("doc", "row", F.explode("seeds").alias("seed")).join(seeds, "seed")
    pairs = pairs.select("doc", "row", "item").distinct()
    pairs = pairs.join(hits.select("doc", "row", "tokens"), ["doc", "row"])
    pairs = pairs.join(item.select("item", F.col("tokens").alias("item_tokens")), "item")
    tiled = pairs.select("doc", "item", "tokens", "item_tokens").mapInArrow(
        _tiled(least), "doc bigint, item bigint, item_tokens bigint, covered_tokens bigint, tiles bigint"
    )
    share = F.col("covered_tokens") / F.col("item_tokens")
    best = tiled.groupBy("doc", "item").agg(
        F.max_by(F.struct("item_tokens", "covered_tokens", "tiles"), F.struct(share, "covered_tokens", "tiles")).alias("best")
    )
    return best.select(
        F.nullif("doc", null).alias("doc_id"),
        F.nullif("item", null).alias("item_id"),
        "best.*",
        (F.col("best.covered_tokens") / F.col("best.item_tokens")).alias("coverage"),
    )


def leaks(docs: DataFrame, items: DataFrame, threshold: float = COVERAGE, least: int = LEAST) -> DataFrame:
    """The pairs whose item is covered to at least `threshold`."""
    return coverage(docs, items, least).filter(F.col("coverage") >= threshold)


def clean(docs: DataFrame, items: DataFrame, threshold: float = COVERAGE, least: int = LEAST) -> DataFrame:
    """The rows of `docs` in which no item leaked.

    Each row is judged by its own text, also where rows share a doc_id: rows are known by a
    hash of doc_id and text.
    """
    given = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    found = leaks(given, items, threshold, least)
    found = found.select(F.col("doc_id").alias("leaked")).distinct()
    # The leaks alone are joined with the texts, so those move only if the leaks are many.
    row = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("doc_id", "text").alias("of"))
    return row.join(found, F.col("of") == F.col("leaked"), "left_anti").select("row.*")
