"""Removal of repeated passages: word windows that also start earlier.

Every window of `size` words has a Rabin-Karp hash, and equal hashes are counted in
Spark.  The windows of a corpus are as many as its words, so a first pass sorts out
those that cannot repeat, in about a ninth of the rows: a window is represented by the
least hash of the shorter windows inside it (its anchor).  Equal windows have equal
anchors, so a window whose anchor occurs once in the corpus occurs once itself.  Only the
other windows are hashed in full, compared, and those that are not the first of their
kind merged into maximal intervals.

Both comparisons are reduced before they are shuffled: what repeats within a slice of
texts is settled there, and a slice sends one row per hash.  So a passage that a third
of all documents share brings one row per slice, not one per document.  The texts move
once, to the rows about them; both joins read that exchange.

Defined results: a null text has no words.  A null doc_id comes before all others.  Rows
with the same doc_id are ordered by start alone, so what one of them has at the same
place as another is no earlier; each row keeps its own result: rows are known by doc_id
and a hash of the text, and rows that agree in both have the same result.  An empty table
gives no rows.  Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W

SIZE = 20
#: Words of the shorter windows that anchors are taken from.
GRAM = 6
FIRST_ID = -(1 << 63)  # in place of a null


def _hashed(texts: pa.Array, hasher: W.Hasher, size: int, gram: int):
    """Words, their hashes, and for each window its start, row and anchor."""
    words = W.split(texts)
    hashes = hasher.words(words, lower=False)
    start, row = W.window_rows(words.first, size)
    grams = W.windows(hashes, gram)
    least = W.smallest(grams, size - gram + 1)
    return words, hashes, start, row, least[start], grams


def _anchors(size: int, gram: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, anchor, doc, mark, weight): documents' anchors; from weight 2 on they repeat.

        An anchor that repeats in the slice is settled for all its documents; one of
        them tells the others in the corpus, the rest need not meet them.
        """
        hasher = W.Hasher()
        for batch in batches:
            for part in W.slices(batch):
                words, _, _, row, anchor, grams = _hashed(part.column("text"), hasher, size, gram)
                if not len(anchor):
                    continue
                inside, _ = W.window_rows(words.first, gram)
                value, count = np.unique(grams[inside], return_counts=True)
                keys, at = np.unique(W.keyed(anchor, row), return_index=True)
                anchor, row = anchor[at], row[at]
                often = count[np.searchsorted(value, anchor)] > 1
                _, first = np.unique(anchor, return_index=True)
                tells = np.zeros(len(anchor), bool)
                tells[first] = True
                doc = part.column("doc").to_numpy(zero_copy_only=False)
                yield pa.record_batch(
                    {
                        "key": pa.array(np.where(tells, anchor, keys).view(np.int64)),
                        "anchor": pa.array(anchor.view(np.int64)),
                        "doc": pa.array(doc[row]),
                        "mark": part.column("mark").take(pa.array(row)),
                        "weight": pa.array(np.where(often, 2, 1).astype(np.int32)),
                    }
                )

    return anchors


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row of each element of a list column, and the elements."""
    lists = column.fill_null([]) if column.null_count else column
    sizes = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False)


def _merged(row: np.ndarray, start: np.ndarray, size: np.ndarray):
    """Maximal intervals of each row from intervals in the order of (row, start)."""
    if not len(row):
        return row, start, size
    high = int((start + size).max()) + 1
    begin, end = row * high + start, row * high + start + size
    reach = np.maximum.accumulate(end)
    new = np.concatenate(([True], (begin[1:] > reach[:-1]) | (row[1:] != row[:-1])))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return row[first], start[first], reach[last] - begin[first]


def _twins(group: np.ndarray, mark: np.ndarray, own: np.ndarray, twin: np.ndarray) -> list[np.ndarray | None]:
    """For each group the marks of its twins other than that of its head, or None."""
    out: list[np.ndarray | None] = [None] * (int(group[-1]) + 1)
    others = np.unique(np.stack([group, mark])[:, twin & (mark != own)], axis=1)
    of, first = np.unique(others[0], return_index=True)
    for g, values in zip(of.tolist(), np.split(others[1], first[1:]), strict=False):
        out[g] = values
    return out


def _windows(size: int, gram: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, doc, mark, twins, start, size, settled): windows to compare, and intervals that go.

        Of equal windows in a slice the first is compared with those of other slices, for
        its twins as well: the same place of other texts with the same doc_id.
        """
        hasher = W.Hasher()
        for batch in batches:
            for part in W.slices(batch):
                words, hashes, start, row, anchor, _ = _hashed(part.column("text"), hasher, size, gram)
                of, repeated = _lists(part.column("anchors"))
                wanted = np.isin(W.keyed(anchor, row), W.keyed(repeated.view(np.uint64), of))
                start, row = start[wanted], row[wanted]
                if not len(start):
                    continue
                key = W.windows(hashes, size)[start]
                start = start - words.first[:-1][row]
                doc = part.column("doc").to_numpy(zero_copy_only=False)[row]
                order = np.lexsort((start, doc, key))
                key, doc, start, row = key[order], doc[order], start[order], row[order]
                new = np.concatenate(([True], key[1:] != key[:-1]))
                head = np.flatnonzero(new)[np.cumsum(new) - 1]
                later = (doc != doc[head]) | (start != start[head])
                by_row = np.lexsort((start[later], row[later]))
                rows, at, long = _merged(
                    row[later][by_row], start[later][by_row], np.full(later.sum(), size)
                )
                doc_of = part.column("doc").to_numpy(zero_copy_only=False)
                mark_of = part.column("mark").to_numpy(zero_copy_only=False)
                twins = _twins(np.cumsum(new) - 1, mark_of[row], mark_of[row][head], ~new & ~later)
                mine = W.mix(rows.astype(np.uint64) ^ doc_of[rows].view(np.uint64))
                yield pa.record_batch(
                    {
                        "key": pa.array(np.concatenate([key[new], mine]).view(np.int64)),
                        "doc": pa.array(np.concatenate([doc[new], doc_of[rows]])),
                        "mark": pa.array(np.concatenate([mark_of[row[new]], mark_of[rows]])),
                        "twins": pa.array([*twins, *[None] * len(rows)], pa.list_(pa.int64())),
                        "start": pa.array(np.concatenate([start[new], at]).astype(np.int32)),
                        "size": pa.array(
                            np.concatenate([np.full(new.sum(), size), long]).astype(np.int32)
                        ),
                        "settled": pa.array(np.repeat([False, True], [new.sum(), len(rows)])),
                    }
                )

    return windows


def _kept(with_text: bool):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row without the words of its intervals."""
        for batch in batches:
            for part in W.slices(batch):
                words = W.split(part.column("text"))
                row, spans = np.zeros(0, np.int64), part.column("spans")
                lists = spans.fill_null([]) if spans.null_count else spans
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                flat = lists.flatten()
                start = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64) + words.first[:-1][row]
                change = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(change, start, 1)
                np.add.at(change, start + flat.field(1).to_numpy(zero_copy_only=False), -1)
                stays = np.cumsum(change[:-1]) == 0
                before = np.concatenate(([0], np.cumsum(stays)))[words.first]
                begin, size = words.start[stays], (words.end - words.start)[stays] + 1
                edge = np.concatenate(([0], np.cumsum(size)))
                index = np.arange(edge[-1]) + np.repeat(begin - edge[:-1], size)
                text = np.append(words.data, np.uint8(0x20))[np.minimum(index, len(words.data))]
                text[edge[1:] - 1] = 0x20  # one space behind each word
                ends = edge[before]
                made = [text[a : max(a, b - 1)] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                count = words.counts()
                out = {
                    "doc": part.column("doc"),
                    "n_words": pa.array(count),
                    "n_removed": pa.array(count - np.diff(before)),
                    "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in made]),
                }
                if with_text:
                    out["kept"] = pa.array([x.tobytes().decode() for x in made], pa.string())
                yield pa.record_batch(out)

    return kept


def removals(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """(doc, mark, spans): for each document the (start, size) of its words that go.

    `docs` has doc, mark and text, and equal texts where doc and mark are; spans may overlap.
    """
    found = docs.mapInArrow(_anchors(size, gram), "key bigint, anchor bigint, doc bigint, mark bigint, weight int")
    shared = found.withColumn("weight", F.sum("weight").over(Window.partitionBy("key")))
    repeated = shared.filter("weight > 1").groupBy("doc", "mark").agg(F.collect_set("anchor").alias("anchors"))
    suspects = docs.join(repeated, ["doc", "mark"]).select("doc", "mark", "text", "anchors")
    windows = suspects.mapInArrow(
        _windows(size, gram), "key bigint, doc bigint, mark bigint, twins array<bigint>, start int, size int, settled boolean"
    )
    first = F.rank().over(Window.partitionBy("key").orderBy("doc", "start")) == 1
    later = windows.select("doc", "mark", "twins", "start", "size", (F.col("settled") | ~first).alias("goes")).filter("goes")
    marks = F.concat(F.array("mark"), F.coalesce("twins", F.expr("cast(array() AS array<bigint>)")))
    later = later.select("doc", F.explode(marks).alias("mark"), "start", "size")
    return later.groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "size")).alias("spans"))


def deduplicate(docs: DataFrame, size: int = SIZE, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) for every row of `docs`."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_ID))
    # The same columns in both joins, so that they read one exchange.
    given = docs.select(key.alias("doc"), F.xxhash64("text").alias("mark"), "text")
    out = given.join(removals(given, size), ["doc", "mark"], "left").select("doc", "text", "spans")
    columns = "doc bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    made = out.mapInArrow(_kept(with_text), columns + ", kept string" * with_text)
    return made.select(F.nullif("doc", F.lit(FIRST_ID)).alias("doc_id"), *made.columns[1:])
