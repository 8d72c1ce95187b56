"""Phrases whose words stand together more often than chance would put them there.

Texts are cut into pieces at punctuation and line ends, pieces into words; only A-Z are
lower-cased.  A phrase is a run of words inside a piece, f(phrase) counts all its
occurrences per language, overlapping ones too.

Every word starts one window: the word and its next four as lead columns, padded where the
piece ends.  Only these longest windows are counted; a ROLLUP over the columns then sums
them up to shorter and shorter prefixes, which are the counts of all phrases, and on its
last level n, the count of all words.

Most windows occur once, and a phrase as rare as that is not asked for.  So a first pass
counts words and pairs of neighbours in hashed cells, and a second one the runs of three
to five words whose pairs all may be frequent.  A cell counts at least as much as any run
in it, so where it counts fewer than `least`, no phrase that holds the run is frequent,
and windows are padded from there on; those that are all padding still count in n.  No
frequent phrase loses an occurrence.  There are
cells in proportion to the text, up to `MOST_CELLS`; beyond, windows are padded less
often, which costs time and changes no result.

Defined results: null texts count as empty, a null language as `und`; the language `und`
itself is the same one.  Repeated rows count each.  Where nothing is frequent, or the
table is empty, there are no rows.  Ids and further columns are not looked at.  Words are
told apart by their bytes; n, f and scores are exact (scores by 38-digit decimals).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.store import written

LEAST, LONGEST, KEPT = 100, 5, 2000
#: What ends a piece, and what else parts words.
BREAKS, BLANKS = ".,;:!?\n\x0b\f\r", " \t"
NO_LANGUAGE = "und"
#: Cells of the pair counts: one for so many bytes of text, within these bounds.
CELL_BYTES, LEAST_CELLS, MOST_CELLS, CHUNK_CELLS = 64, 1 << 18, 1 << 26, 1 << 16
#: Parts of a language that are ranked on their own before the best of all are.
RANK_PARTS = 32
COLUMNS = [f"w{i}" for i in range(1, LONGEST + 1)]

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in BREAKS]] = True
_GAP = _BREAK.copy()
_GAP[[ord(c) for c in BLANKS]] = True


def _languages(part: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    coded = part.column("lang").dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _joined(words: W.Words) -> np.ndarray:
    """For each word but the last, whether the next one stands in the same piece."""
    breaks = np.concatenate(([0], np.cumsum(_BREAK[words.data])))
    row = words.row_of_word()
    return (row[1:] == row[:-1]) & (breaks[words.start[1:]] == breaks[words.end[:-1]])


def _cells(hashes: np.ndarray, tags: np.ndarray, size: int, cells: int) -> np.ndarray:
    """The cell of each run of `size` words, by the tag of its first word's language."""
    runs = W.windows(hashes, size)
    return (W.mix(runs ^ tags[: len(runs)]) & np.uint64(cells - 1)).astype(np.int64)


def _kind(least: int) -> type:
    return np.uint8 if least < 256 else np.uint32


@dataclass
class Slice:
    """Words of some texts with what is known of the runs that start at each of them."""

    words: W.Words
    hashes: np.ndarray
    language: np.ndarray  # of each word, a number of `names`
    names: pa.Array
    tags: np.ndarray  # of each word's language
    goes_on: np.ndarray  # whether the next word stands in the same piece

    @classmethod
    def of(cls, part: pa.RecordBatch, hasher: W.Hasher) -> Slice | None:
        words = W.split(part.column("text"), _GAP)
        if not len(words.start):
            return None
        language, names = _languages(part)
        language = language[words.row_of_word()]
        marks = [int.from_bytes(n.encode()[-8:], "little") for n in names.to_pylist()]
        tags = W.mix(W.mix(np.array(marks, np.uint64)) + np.uint64(1))[language]
        goes_on = np.append(_joined(words), False)
        return cls(words, hasher.words(words, lower=True), language, names, tags, goes_on)

    def lengths(self, *filters: np.ndarray) -> np.ndarray:
        """How many words from each on may be frequent together, as far as the filters tell.

        The first filter knows words and pairs of them, the second longer runs.
        """
        n = len(self.goes_on)
        length, able = np.zeros(n, np.int64), None
        for size in range(1, LONGEST + 1):
            # Both runs of one word less have to be frequent, and this one.
            both = np.ones(n, bool)
            if size > 1:
                both = able & np.append(able[1:], False)
            if size == 2:
                both &= self.goes_on
            bits = filters[0] if size <= 2 else filters[1] if len(filters) > 1 else None
            at = np.flatnonzero(both)
            if bits is not None and len(at):
                cell = _cells(self.hashes, self.tags, size, len(bits) * 8)[at]
                both[at] = (bits[cell >> 3] >> (cell & 7)) & 1
            able = both
            length += able
        return length


def _count_runs(cells: int, least: int, pairs: np.ndarray | None):
    """Counts of runs per cell: of words and pairs, or of all longer runs that pass a filter of those."""
    kind, chunk = _kind(least), min(cells, CHUNK_CELLS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, hasher = np.zeros(cells, np.uint32), W.Hasher()
        for batch in batches:
            for part in W.slices(batch):
                some = Slice.of(part, hasher)
                if some is None:
                    continue
                length = some.goes_on + 1 if pairs is None else some.lengths(pairs)
                for size in (1, 2) if pairs is None else range(3, LONGEST + 1):
                    at = np.flatnonzero(length >= size)
                    if len(at):
                        cell, n = np.unique(_cells(some.hashes, some.tags, size, cells)[at], return_counts=True)
                        total[cell] = np.minimum(total[cell] + n, least)
        rows = total.astype(kind).reshape(-1, chunk)
        for i in np.flatnonzero(rows.any(axis=1)):
            packed = pa.compress(rows[i].tobytes(), "zstd", asbytes=True)
            yield pa.record_batch({"chunk": pa.array([i], pa.int32()), "cells": pa.array([packed], pa.binary())})

    return count


def _frequent_cells(least: int, chunk: int):
    kind = _kind(least)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, cells in zip(batch.column("chunk").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                counts = pa.decompress(cells, chunk * np.dtype(kind).itemsize, "zstd", asbytes=True)
                part = np.frombuffer(counts, kind).astype(np.uint32)
                total[at] = np.minimum(total.get(at, 0) + part, least)
        bits = [np.packbits(t >= least, bitorder="little").tobytes() for t in total.values()]
        yield pa.record_batch({"chunk": pa.array(total, pa.int32()), "cells": pa.array(bits, pa.binary())})

    return frequent


def frequent_runs(texts: DataFrame, cells: int, least: int, pairs: np.ndarray | None = None) -> np.ndarray:
    """A bit for each cell, set where it holds `least` runs of words or more."""
    shape, chunk = "chunk int, cells binary", min(cells, CHUNK_CELLS)
    counts = texts.mapInArrow(_count_runs(cells, least, pairs), shape)
    # The bits of all cells, so MOST_CELLS / 8 bytes at most.
    rows = counts.repartition(cells // chunk, "chunk").mapInArrow(_frequent_cells(least, chunk), shape).collect()
    bits = np.zeros((cells // chunk, chunk // 8), np.uint8)
    for row in rows:
        bits[row["chunk"]] = np.frombuffer(row["cells"], np.uint8)
    return bits.ravel()


def _distinct_windows(code: np.ndarray, first: np.ndarray, length: np.ndarray, many: int):
    """Word places and counts of the distinct windows of each length.

    `first` numbers the languages of the words, `code` the words themselves.
    """
    for size in range(LONGEST + 1):
        at = np.flatnonzero(length == size)
        if not len(at):
            continue
        key = first[at]
        for k in range(size):
            key = np.unique(key, return_inverse=True)[1] * many + code[at + k]
        _, place, count = np.unique(key, return_index=True, return_counts=True)
        yield size, at[place], count


def _windows(*filters: np.ndarray):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher()
        for batch in batches:
            for part in W.slices(batch):
                some = Slice.of(part, hasher)
                if some is None:
                    continue
                words, names, length = some.words, some.names, some.lengths(*filters)
                n = len(length)
                inside = ~_GAP[words.data]
                sizes = words.end - words.start
                if sizes.sum() != inside.sum():  # bytes below a null
                    edges = np.zeros(len(words.data) + 1, np.int64)
                    np.add.at(edges, words.start, 1)
                    np.add.at(edges, words.end, -1)
                    inside = np.cumsum(edges[:-1]) > 0
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
                letters = W._LOWER[words.data[inside]]
                spelt = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
                coded = spelt.dictionary_encode()
                code = coded.indices.to_numpy().astype(np.int64)
                spelling = coded.dictionary.cast(pa.large_string())
                for size, at, count in _distinct_windows(code, some.language, length, len(spelling)):
                    out = {"lang": names.take(pa.array(some.language[at]))}
                    for k, name in enumerate(COLUMNS):
                        out[name] = spelling.take(pa.array(code[at + k])).cast(pa.string()) if k < size else pa.nulls(len(at), pa.string())
                    yield pa.record_batch(out | {"n": pa.array(count, pa.int64())})

    return windows


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, k, f) of all phrases of k words with f >= least, and of no words with f = n."""
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    cells = min(max(LEAST_CELLS, 1 << (size // CELL_BYTES).bit_length()), MOST_CELLS)
    pairs = frequent_runs(texts, cells, least)
    runs = frequent_runs(texts, cells, least, pairs)
    shape = ", ".join(f"{c} string" for c in ["lang", *COLUMNS]) + ", n bigint"
    windows = texts.mapInArrow(_windows(pairs, runs), shape).groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n"))
    sums = windows.rollup("lang", *COLUMNS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # Bits of the level stand for the columns summed over, the last one lowest.
    k = LONGEST - F.length(F.regexp_replace(F.bin("level"), "0", "")).cast("int")
    sums = sums.withColumn("k", F.when(F.col("level") == 0, LONGEST).otherwise(k))
    whole = F.col("k") == 0
    for i, name in enumerate(COLUMNS, 1):
        whole |= (F.col("k") == i) & F.col(name).isNotNull()
    sums = sums.filter(whole & ((F.col("f") >= least) | (F.col("k") == 0)))
    phrase = F.array_join(F.slice(F.array(*COLUMNS), F.lit(1), F.col("k")), " ")
    return sums.select("lang", phrase.alias("phrase"), "k", "f")


def _parts(phrase: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, size), " ")


def cut_scores(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words or more, at their worst cuts."""
    totals = written(counts.filter("k = 0").select("lang", F.col("f").alias("n")), "phrase-totals")
    some = counts.filter("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"))
    cuts = some.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut",
        _parts(F.col("phrase"), F.lit(1), F.col("cut")).alias("left"),
        _parts(F.col("phrase"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"),
    )
    known = counts.filter("k >= 1")
    for side, name in (("left", "l"), ("right", "r")):
        own = known.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = cuts.join(own, ["lang", side])
    cuts = cuts.join(totals, "lang")

    def product(*names: str) -> Column:
        out = F.lit(1).cast("decimal(1,0)")
        for name in names:
            out = out * F.col(name).cast("decimal(18,0)")
        return out.cast("decimal(38,0)")

    cuts = cuts.withColumns({"over": product("a", "n") * 1000, "below": product("l", "r")})
    cuts = cuts.withColumn("score", F.expr("cast(over AS decimal(38,0)) div below"))
    worst = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("at"))
    return worst.select("lang", "phrase", "at.a", "at.l", "at.r", "at.n", "at.score")


def _held(counts: DataFrame) -> DataFrame:
    """(lang, phrase, most): phrases inside longer frequent ones, with the largest count of those."""
    longer = counts.filter("k >= 3").select("lang", "phrase", "k", "f")
    sized = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    placed = sized.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    inside = placed.select("lang", _parts(F.col("phrase"), F.col("start"), F.col("size")).alias("phrase"), "f")
    return inside.groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, least: int = LEAST, kept: int = KEPT, percent: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `kept` best phrases.

    Phrases inside a longer frequent one that occurs `percent` as often are left out.
    """
    counts = written(phrase_counts(docs, least), "phrase-counts")
    scored = cut_scores(counts).join(_held(counts), ["lang", "phrase"], "left")
    scored = scored.filter(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a"))).drop("most")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    scored = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = best.filter(F.col("rank") <= kept)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return best.filter(F.col("rank") <= kept).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
