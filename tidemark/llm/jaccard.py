"""Similar documents by the Jaccard index of their word shingles.

Every document's set of shingles is hashed once and kept as a compressed sorted array
beside a bitmap of the hashes.  Documents are compared inside tiles: those that hold one
shingle among the first of their set and whose sizes lie in neighbouring bands.  "First"
is by an order that puts rare shingles in front (a counting sketch of fixed size, over
the whole corpus, tells them apart), so what many documents share makes no large tile.
Any such order is exact: of two sets as similar as asked, each has one of the common
shingles among its first n - ceil(n * t) + 1.  The place that a shingle has in that order
rules out more: where the first common one stands late, too few are left behind it.

Most first shingles are first in one set only.  A pass over them counts up to two in hashed
cells, and those alone in their cell are dropped before any shuffle.  Tiles with the same
members are merged into one, which counts as so many.

A pair is measured in two steps: the bits that one bitmap has and the other has not are
shingles that cannot be shared, which bounds the overlap from above; what is left is
intersected exactly.

The result is components, so pairs inside a component that is known already need no
look.  Pairs in tiles of a few members are listed, without their sets; those that meet
in too few tiles share too little and are dropped.  The others are measured, and in larger
tiles those of a leader with its members; what links is merged.  In the
larger tiles, then, the most similar pair of every two components of a tile, by bitmap; at the
end all pairs of a tile that are still in different components are measured, so no link
is lost.  Copies with equal sets are one node throughout.

Defined results: a null text and one without words have 0 shingles and are alone.  With
fewer words than a shingle has, the whole sequence is the one shingle.  Rows with equal
doc_ids are compared like others.  Null doc_ids count as the smallest id.  An empty table
gives no rows.  Sets are compared by 64-bit fingerprints, shingles by 48 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.components import components
from tidemark.llm.store import written

SHINGLE, PERCENT = 5, 80
#: Cells of the counting sketch, in chunks.
CELLS, CHUNK_CELLS = 1 << 18, 1 << 14
#: Cells that tell which first shingles meet: so many for each of them, within these bounds.
HEAD_CELLS_EACH, LEAST_HEAD_CELLS, MOST_HEAD_CELLS, CHUNK_CELLS_OF_HEADS = 2, 1 << 18, 1 << 28, 1 << 18
#: Smallest bitmap; larger sets have 4 to 8 bits per shingle, so few bits fall together.
LEAST_BITS, BITS_EACH = 64, 4
#: Words of 64 bits of the filter that spares most rows a shuffle.
FILTER_WORDS = 1 << 16
#: Pairs that the last round may compare, per row of the tiles, before a round of best
#: pairs; rounds at most.
LAST_ROUND, MOST_ROUNDS = 1, 3
#: Members of a tile whose pairs are listed and counted before any is measured.
FEW = 16
#: Members of a tile that one task holds against as many others.
TILE_ROWS = 2048
#: Pairs that a task lists at a time, and bytes of bitmaps that it lays side by side.
PAIRS, LOOK_BYTES = 1 << 18, 8 << 20
SPREAD = np.uint64(0x9E3779B97F4A7C15)
NULL_ID = -(1 << 63)


# --- sets -------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Sorted 48-bit values as differences, byte by byte place: these compress well."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    n = len(data) // 6
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(6, n).T
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def signature(values: np.ndarray) -> bytes:
    bits = max(LEAST_BITS, 1 << int(BITS_EACH * len(values) - 1).bit_length())
    marks = np.zeros(bits, np.uint8)
    marks[(values % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def overlap_bound(a: bytes, b: bytes, n: int, m: int) -> int:
    """At most so many of the n and m values are shared."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):  # places are taken modulo the size, so halves fold
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))


def _sets(size: int, keys: list[str]):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher()
        for batch in batches:
            for part in W.slices(batch):
                words = W.split(part.column("text"))
                hashes = hasher.words(words, lower=True)
                start, row = W.window_rows(words.first, size)
                shingles = W.windows(hashes, size)[start]
                edges = np.searchsorted(row, np.arange(part.num_rows + 1))
                n, prints, arrays, bitmaps = [], [], [], []
                for i in range(part.num_rows):
                    values = np.unique(shingles[edges[i] : edges[i + 1]])
                    short = hashes[words.first[i] : words.first[i + 1]]
                    if 0 < len(short) < size:
                        values = W.mix(W.windows(short, len(short)) ^ np.uint64(len(short)))
                    n.append(len(values))
                    if not len(values):
                        prints.append(None), arrays.append(None), bitmaps.append(None)
                        continue
                    mark = hashlib.blake2b(values.tobytes(), digest_size=8).digest()
                    prints.append(int.from_bytes(mark, "little", signed=True))
                    values = np.sort(values >> np.uint64(16))
                    arrays.append(pack(values))
                    bitmaps.append(signature(values))
                yield pa.record_batch(
                    {
                        **{k: part.column(k) for k in keys},
                        "n": pa.array(n, pa.int64()),
                        "print": pa.array(prints, pa.int64()),
                        "signature": pa.array(bitmaps, pa.binary()),
                        "shingles": pa.array(arrays, pa.binary()),
                    }
                )

    return sets


# --- the order of shingles --------------------------------------------------


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS, np.int32)
    for batch in batches:
        for data in batch.column("shingles"):
            np.add.at(total, (unpack(data.as_py()) & np.uint64(CELLS - 1)).astype(np.int64), 1)
    chunks = [c.tobytes() for c in np.split(total, CELLS // CHUNK_CELLS)]
    yield pa.record_batch({"chunk": pa.array(range(len(chunks)), pa.int32()), "cells": pa.array(chunks, pa.binary())})


def _add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, cells in zip(batch.column("chunk").to_pylist(), batch.column("cells"), strict=True):
            part = np.frombuffer(cells.as_py(), np.int32).astype(np.int64)
            total[chunk] = total.get(chunk, 0) + part
    levels = [np.ceil(np.log2(np.maximum(t, 1))).astype(np.uint8).tobytes() for t in total.values()]
    yield pa.record_batch({"chunk": pa.array(total, pa.int32()), "cells": pa.array(levels, pa.binary())})


def levels(sets: DataFrame) -> np.ndarray:
    """For each cell of the sketch, how frequent its shingles are, as a power of 2."""
    shape = "chunk int, cells binary"
    parts = sets.filter("n > 0").select("shingles").mapInArrow(_count_cells, shape)
    chunks = CELLS // CHUNK_CELLS
    rows = parts.repartition(chunks, "chunk").mapInArrow(_add_cells, shape).collect()  # CELLS bytes
    out = np.zeros(CELLS, np.uint8)
    for row in rows:
        out[row["chunk"] * CHUNK_CELLS : (row["chunk"] + 1) * CHUNK_CELLS] = np.frombuffer(row["cells"], np.uint8)
    return out


def _head(data: pa.Scalar, percent: int, level: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the order of all shingles."""
    values = unpack(data.as_py())
    n = len(values)
    first = n - -(-percent * n // 100) + 1
    rank = level[(values & np.uint64(CELLS - 1)).astype(np.int64)]
    # Spread within a level, so that the order does not favour small hashes; an odd
    # factor keeps different hashes apart.
    order = (rank.astype(np.uint64) << np.uint64(48)) | (values * SPREAD & np.uint64((1 << 48) - 1))
    head = np.argpartition(order, first - 1)[:first] if first < n else np.arange(n)
    return values[head[np.argsort(order[head])]]


def _head_cells(keys: np.ndarray, cells: int) -> np.ndarray:
    return (W.mix(keys) & np.uint64(cells - 1)).astype(np.int64)


def _count_heads(percent: int, level: np.ndarray, cells: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, chunk = np.zeros(cells, np.uint8), min(cells, CHUNK_CELLS_OF_HEADS)
        for batch in batches:
            keys = [_head(data, percent, level) for data in batch.column("shingles")]
            if keys:
                cell, n = np.unique(_head_cells(np.concatenate(keys), cells), return_counts=True)
                total[cell] = np.minimum(total[cell] + np.minimum(n, 2), 2)
        rows = total.reshape(-1, chunk)
        for i in np.flatnonzero(rows.any(axis=1)):
            packed = pa.compress(rows[i].tobytes(), "zstd", asbytes=True)
            yield pa.record_batch({"chunk": pa.array([i], pa.int32()), "cells": pa.array([packed], pa.binary())})

    return count


def _met_cells(chunk: int):
    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, data in zip(batch.column("chunk").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                part = np.frombuffer(pa.decompress(data, chunk, "zstd", asbytes=True), np.uint8)
                total[at] = np.minimum(total.get(at, 0) + part, 2)
        bits = [np.packbits(t >= 2, bitorder="little").tobytes() for t in total.values()]
        yield pa.record_batch({"chunk": pa.array(total, pa.int32()), "cells": pa.array(bits, pa.binary())})

    return met


def met_heads(sets: DataFrame, percent: int, level: np.ndarray) -> np.ndarray:
    """A bit for each hashed cell: whether two first shingles or more fall into it.

    A shingle in a cell of its own is first in one set only and makes no pair.
    """
    filled = sets.filter("n > 0")
    size = filled.agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()[0] or 0
    cells = min(max(LEAST_HEAD_CELLS, 1 << int(HEAD_CELLS_EACH * size).bit_length()), MOST_HEAD_CELLS)
    chunk, shape = min(cells, CHUNK_CELLS_OF_HEADS), "chunk int, cells binary"
    counts = filled.select("shingles").mapInArrow(_count_heads(percent, level, cells), shape)
    # The bits of all cells, so MOST_HEAD_CELLS / 8 bytes at most.
    rows = counts.repartition(cells // chunk, "chunk").mapInArrow(_met_cells(chunk), shape).collect()
    bits = np.zeros((cells // chunk, chunk // 8), np.uint8)
    for row in rows:
        bits[row["chunk"]] = np.frombuffer(row["cells"], np.uint8)
    return bits.ravel()


def _prefixes(percent: int, level: np.ndarray, met: np.ndarray):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, print, n, pos): each set under its first shingles, and their places in the order.

        Shingles that no other set has among its first are left out.
        """
        for batch in batches:
            keys, sizes, places = [], [], []
            for data in batch.column("shingles"):
                head = _head(data, percent, level)
                cell = _head_cells(head, len(met) * 8)
                place = np.flatnonzero((met[cell >> 3] >> (cell & 7)) & 1)
                keys.append(head[place])
                sizes.append(len(place))
                places.append(place.astype(np.int32))
            if keys:
                at = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
                key = np.concatenate(keys).view(np.int64)
                yield pa.record_batch(
                    {
                        "key": pa.array(key),
                        "print": batch.column("print").take(at),
                        "n": batch.column("n").take(at),
                        "pos": pa.array(np.concatenate(places)),
                    }
                )

    return prefixes


def band(n: Column, percent: int) -> Column:
    """Sizes whose ratio is `percent` at least lie in the same band or in neighbours."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)) + F.lit(1e-9)).cast("int")


# --- pairs ------------------------------------------------------------------


def _bounded(percent: int):
    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(
                batch.column("a_signature").to_pylist(),
                batch.column("b_signature").to_pylist(),
                batch.column("a_n").to_pylist(),
                batch.column("b_n").to_pylist(),
                strict=True,
            )
            able = []
            for x, y, n, m in rows:
                most = overlap_bound(x, y, n, m)
                able.append(100 * most >= percent * (n + m - most))
            yield batch.select(["a", "b"]).filter(pa.array(able, pa.bool_()))

    return bounded


def _exact(percent: int):
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("a_shingles"), batch.column("b_shingles"), strict=True):
                x, y = unpack(x.as_py()), unpack(y.as_py())
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[place] == x).sum())
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return exact


def among(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose value may be among `wanted`, without a shuffle.

    A bitmap of `FILTER_WORDS` words, whatever the size of `wanted`, so it may be broadcast;
    some other rows pass as well.
    """
    place = F.pmod(F.xxhash64(column), F.lit(FILTER_WORDS * 64))
    bits = wanted.select(F.shiftright(place, 6).alias("word"), F.expr("1L").alias("one"), F.pmod(place, F.lit(64)).alias("bit"))
    bits = bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, cast(bit AS int))")).alias("bits"))
    held = rows.withColumn("word", F.shiftright(place, 6)).join(F.broadcast(bits), "word")
    hit = F.expr(f"(shiftright(bits, cast(pmod(xxhash64(`{column}`), 64) AS int)) & 1) = 1")
    return held.filter(hit).select(rows.columns)


class Measured:
    """Links among pairs of sets."""

    def __init__(self, sets: DataFrame, nodes: DataFrame, percent: int) -> None:
        self.sets, self.percent = sets, percent
        marks = among(sets.select("print", "n", "signature"), "print", nodes).groupBy("print").agg(
            F.first("n").alias("n"), F.first("signature").alias("signature")
        )
        self.marks = written(marks, "jaccard-signatures")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of `pairs` (a, b), those that are similar enough."""
        marked = pairs
        for side in "ba":
            own = self.marks.select(*[F.col(c).alias(f"{side}_{c}") for c in self.marks.columns])
            marked = marked.join(own, F.col(side) == F.col(f"{side}_print"))
        marked = marked.select("a", "b", "a_n", "b_n", "a_signature", "b_signature")
        return self.exact(marked.mapInArrow(_bounded(self.percent), "a bigint, b bigint"))

    def exact(self, able: DataFrame) -> DataFrame:
        """Of pairs that their bitmaps leave, those that are similar enough."""
        able = written(able, "jaccard-able")
        needed = able.select(F.col("a").alias("print")).union(able.select("b")).distinct()
        arrays = among(self.sets.select("print", "shingles"), "print", needed)
        arrays = arrays.groupBy("print").agg(F.first("shingles").alias("shingles"))
        held = able
        for side in "ba":
            own = arrays.select(*[F.col(c).alias(f"{side}_{c}") for c in arrays.columns])
            held = held.join(own, F.col(side) == F.col(f"{side}_print"))
        held = held.select("a", "b", "a_shingles", "b_shingles")
        return held.mapInArrow(_exact(self.percent), "a bigint, b bigint")


    def open_pairs(self, tiles: DataFrame, best: bool) -> DataFrame:
        """Pairs in different components of one tile that their bitmaps leave.

        Every tile is a bit matrix in one task, or several where it is large.  With `best`,
        of the pairs between the same two components only the most similar one by bitmap.
        """
        marks = self.marks.select(F.col("print").alias("of"), "signature")
        rows = tiles.join(marks, F.col("print") == F.col("of"))
        parts = F.ceil(F.col("all") / TILE_ROWS).cast("int")
        rows = rows.withColumns({"parts": parts, "own": F.pmod(F.xxhash64("print"), parts).cast("int")})
        held = ["key", "print", "n", "pos", "comp", "signature", (F.col("comp") != F.col("main")).alias("out")]
        yes, no = F.lit(True), F.lit(False)
        # One row does for both parts where the tile is one task.
        whole = rows.filter("parts = 1").select(*held, F.expr("comp <> main").alias("asks"), yes.alias("meets"), "own", F.lit(0).alias("y"))
        large = rows.filter("parts > 1").withColumn("each", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        asks = large.filter("comp <> main").select(*held, yes.alias("asks"), no.alias("meets"), F.col("own").alias("x"), F.col("each").alias("y"))
        meets = large.select(*held, no.alias("asks"), yes.alias("meets"), F.col("each").alias("x"), F.col("own").alias("y"))
        dealt = whole.withColumnRenamed("own", "x").unionByName(asks).unionByName(meets).repartition("key", "x", "y")
        dealt = dealt.sortWithinPartitions("key", "x", "y", F.desc("meets"))
        return dealt.mapInArrow(_bit_tiles(self.percent, best), "a bigint, b bigint").distinct()


def _fold(marks: list[bytes], words: int) -> np.ndarray:
    """Bitmaps as rows of a matrix, folded to so many words of 64 bits."""
    out = np.zeros((len(marks), words), np.uint64)
    for i, m in enumerate(marks):
        out[i] = np.bitwise_or.reduce(np.frombuffer(m, np.uint64).reshape(-1, words), axis=0)
    return out


def _narrow(bits: np.ndarray) -> np.ndarray:
    """The same bitmaps at a quarter of the size: a looser bound, at a quarter of the work."""
    if bits.shape[1] < 4:
        return bits
    return np.bitwise_or.reduce(bits.reshape(len(bits), 4, -1), axis=1)


def _ones(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


def _bit_tiles(percent: int, best: bool):
    def low_high(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1)

    def able(t: pa.Table, place: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Ends, components and bound of the pairs that stay, of whole tiles whose members stand before who asks."""
        asks, meets, out = (t.column(c).to_numpy() for c in ("asks", "meets", "out"))
        n, pos, name, comp = (t.column(c).to_numpy() for c in ("n", "pos", "print", "comp"))
        marks = t.column("signature")
        words = pc.binary_length(marks).to_numpy() // 8
        room = n - pos  # shared at most, where the tile's shingle is the first common one
        start = np.flatnonzero(np.append(True, (place[:, 1:] != place[:, :-1]).any(axis=0)))
        tile = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(asks))))
        members = np.add.reduceat(meets.astype(np.int64), start)
        left = np.flatnonzero(asks)
        ends = np.cumsum(members[tile[left]])
        at = 0
        while at < len(left):
            done = int(ends[at - 1]) if at else 0
            to = max(int(np.searchsorted(ends, done + PAIRS, "right")), at + 1)
            each = members[tile[left[at:to]]]
            i = np.repeat(left[at:to], each)
            j = start[tile[i]] + np.arange(len(i)) - np.repeat(ends[at:to] - each - done, each)
            at = to
            need = -(-percent * (n[i] + n[j]) // (100 + percent))
            met = (comp[i] != comp[j]) & (room[i] >= need) & (room[j] >= need)
            met &= ~out[j] | (name[j] > name[i])  # two others meet twice
            i, j, need = i[met], j[met], need[met]
            width = np.minimum(words[i], words[j])
            for w in np.unique(width):
                some = np.flatnonzero(width == w)
                rows, ends_of = np.unique(np.concatenate([i[some], j[some]]), return_inverse=True)
                bits = _fold(marks.take(pa.array(rows)).to_pylist(), int(w))
                a, b = ends_of[: len(some)], ends_of[len(some) :]
                for looked in (_narrow(bits), bits):
                    ones, step = _ones(looked), max(LOOK_BYTES // (8 * looked.shape[1]), 1)
                    stay, most = np.zeros(len(a), bool), np.zeros(len(a), np.int64)
                    for k in range(0, len(a), step):
                        x, y = a[k : k + step], b[k : k + step]
                        spare = np.minimum(n[rows[x]] - ones[x], n[rows[y]] - ones[y])
                        most[k : k + step] = spare + _ones(looked[x] & looked[y])
                        stay[k : k + step] = most[k : k + step] >= need[some[k : k + step]]
                    a, b, some, most = a[stay], b[stay], some[stay], most[stay]
                x, y = name[rows[a]], name[rows[b]]
                share = most / np.maximum(n[rows[a]] + n[rows[b]] - most, 1)
                yield low_high(x, y), low_high(comp[rows[a]], comp[rows[b]]), share

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []

        def closed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t, ends = pa.Table.from_batches(parts).combine_chunks(), np.zeros((0, 2), np.int64)
            if t.num_rows:
                place = np.stack([t.column(c).to_numpy() for c in ("key", "x", "y")])
                found = [*zip(*able(t, place), strict=True)]
                if found:
                    ends, comps, share = (np.concatenate(f) for f in found)
                    if best:
                        order = np.lexsort((ends[:, 1], ends[:, 0], -share))
                        ends = ends[order][np.unique(comps[order], axis=0, return_index=True)[1]]
                    ends = np.unique(ends, axis=0)
            return pa.record_batch({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.stack([batch.column(c).to_numpy() for c in ("key", "x", "y")])
            same = (place == place[:, -1:]).all(axis=0)
            last = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            head = batch.slice(0, last)
            if last:
                yield closed([*rest, head])
                rest = []
            elif rest:
                end = [rest[-1].column(c)[-1].as_py() for c in ("key", "x", "y")]
                if end != place[:, 0].tolist():
                    yield closed(rest)
                    rest = []
            rest.append(batch.slice(last))
        if rest:
            yield closed(rest)

    return tiles


def _pairs(left: DataFrame, tiles: DataFrame, percent: int) -> DataFrame:
    """Pairs of `left` and members of the same tiles, of fitting sizes; some come often."""
    near = left.withColumn("band", F.explode(F.expr("sequence(band - 1, band + 1)")))
    near = near.select("key", "band", F.col("print").alias("p"), F.col("n").alias("m"))
    met = tiles.join(near, ["key", "band"]).filter("print <> p")
    met = met.filter(F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
    return met.select(F.least("print", "p").alias("a"), F.greatest("print", "p").alias("b"))


def _merged(rows: DataFrame) -> DataFrame:
    """(key, members, weight): one tile for all that have the same members, and how many they are.

    Near copies share most of their first shingles, each of which makes the same tile.  The
    one whose shingle comes first in the order stays: all members have it earlier than the
    others, so no bound by places is tighter there.  Members are compared by 128 bits of
    their hashes; they are counted behind the exchanges that `rows` come from, of which all
    columns are read here as well, so that both read the same ones.
    """
    same = [F.bit_xor(F.xxhash64("print", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    by_key = rows.groupBy("key").agg(
        F.count("*").alias("members"), *same, F.sum("n").alias("total"), F.min("least").alias("least"), F.sum("pos").alias("places")
    )
    alike = by_key.groupBy("members", "mark0", "mark1", "total", "least")
    first = alike.agg(F.min(F.struct("places", "key")).alias("first"), F.count("*").alias("weight"))
    return first.select("first.key", "members", "weight")


def _frequent_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that meet in enough of the tiles that have a few members each.

    Of two sets take the one whose first shingles end earlier in the order: what both
    share up to there is first in either.  So they share no more than the tiles they meet
    in and what the larger one has behind its first shingles.  Of the other tiles they
    meet in those at most that the one with less of them is in.
    """
    few = F.col("members") <= FEW
    other = tiles.filter(~few).groupBy("print").agg(F.sum("weight").alias("other"))
    rows = tiles.filter(few).select("key", "print", "n", "weight").join(other, "print", "left")
    rows = written(rows.select("key", "print", "n", "weight", F.coalesce("other", F.lit(0)).alias("other")), "jaccard-few")
    left = rows.select("key", "weight", F.col("print").alias("a"), "n", "other")
    right = rows.select("key", F.col("print").alias("b"), F.col("n").alias("m"), F.col("other").alias("others"))
    met = left.join(right, "key").filter("a < b")
    met = met.filter(F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
    met = met.groupBy("a", "b", "n", "m", "other", "others").agg(F.sum("weight").alias("tiles"))
    need = F.expr(f"({percent} * (n + m) + {99 + percent}) div {100 + percent}")
    behind = F.expr(f"({percent} * greatest(n, m) + 99) div 100 - 1")
    return met.filter(F.col("tiles") + F.least("other", "others") + behind >= need).select("a", "b")


def link_components(sets: DataFrame, percent: int) -> DataFrame:
    """(node, root): the fingerprints of sets that have links, and their components."""
    shape = "key bigint, print bigint, n bigint, pos int"
    level = levels(sets)
    prefixes = _prefixes(percent, level, met_heads(sets, percent, level))
    first = sets.filter("n > 0").select("print", "n", "shingles").mapInArrow(prefixes, shape)
    first = written(first, "jaccard-first")
    shared = first.groupBy("key").agg(F.min("n").alias("least"), F.min("print").alias("low"), F.max("print").alias("high"))
    shared = shared.filter("low <> high").select("key", "least")
    # Shared with the least set of the tile that may be similar, so with any of them.
    need = F.expr(f"({percent} * (n + greatest(least, ({percent} * n + 99) div 100)) + {99 + percent}) div {100 + percent}")
    whole = first.join(shared, "key").withColumn("able", F.col("n") - F.col("pos") >= need)
    whole = whole.groupBy("key", "print").agg(
        F.max("n").alias("n"), F.min("pos").alias("pos"), F.max("able").alias("able"), F.min("least").alias("least")
    )
    whole = whole.join(_merged(whole), "key").drop("least")
    whole = written(whole.withColumn("band", band(F.col("n"), percent)), "jaccard-tiles")
    tiles = whole.filter("able").drop("able", "weight")
    measured = Measured(sets, tiles.select("print").distinct(), percent)
    tile_rows = tiles.count()
    # All pairs of the tiles of a few members are listed, so leaders are for the others.
    large = tiles.filter(F.col("members") > FEW).drop("members")
    leaders = large.groupBy("key", "band").agg(F.min(F.struct("print", "n")).alias("top"))
    pairs = _pairs(leaders.select("key", "band", "top.*"), large, percent)
    pairs = written(pairs.unionByName(_frequent_pairs(whole, percent)).distinct(), "jaccard-pairs")
    links = written(measured.links(pairs), "jaccard-links")
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    for turn in range(1, MOST_ROUNDS):
        held = large.join(roots, large["print"] == roots["node"], "left")
        held = held.select("key", "print", "n", "pos", "band", F.coalesce("root", "print").alias("comp"))
        sizes = held.groupBy("key", "comp").agg(F.count("*").alias("size"))
        mains = sizes.groupBy("key").agg(
            F.max(F.struct("size", "comp")).alias("main"), F.sum("size").alias("all"), F.count("*").alias("comps")
        )
        mains = mains.filter("comps > 1")
        mains = mains.select("key", F.col("main.comp").alias("main"), "all", (F.col("all") - F.col("main.size")).alias("rest"))
        mains = written(mains, "jaccard-open")
        left = mains.agg(F.sum(F.col("all") * F.col("rest"))).first()[0] or 0
        if not left:
            break
        open_tiles = written(held.join(mains, "key"), "jaccard-open")
        last = left <= LAST_ROUND * tile_rows or turn == MOST_ROUNDS - 1
        found = written(measured.exact(measured.open_pairs(open_tiles, best=not last)), "jaccard-links")
        links = links.unionByName(found)
        roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        if last:
            break
    return roots


def _linked(given: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sets with the keys of `given`, its columns but text, and (print, node, root) of those with links."""
    keys = [c for c in given.columns if c != "text"]
    shape = ", ".join(f"{k} bigint" for k in keys) + ", n bigint, print bigint, signature binary, shingles binary"
    sets = written(given.mapInArrow(_sets(size, keys), shape), "jaccard-sets")
    return sets, link_components(sets, percent)


def similar(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs` (doc_id, text)."""
    null = F.lit(NULL_ID)
    given = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), null).alias("doc"), "text")
    sets, roots = _linked(given, size, percent)
    # The least document of each set, then of each component.
    least = sets.filter("n > 0").groupBy("print").agg(F.min("doc").alias("least"))
    rooted = least.join(roots, F.col("print") == F.col("node"), "left")
    rooted = rooted.select("print", "least", F.coalesce("root", "print").alias("root"))
    tops = rooted.groupBy("root").agg(F.min("least").alias("top"))
    tops = rooted.join(tops, "root").select(F.col("print").alias("of"), "top")
    out = sets.select("doc", "n", "print").join(tops, F.col("print") == F.col("of"), "left")
    return out.select(
        F.nullif("doc", null).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("top", "doc"), null).alias("component_id"),
    )


def representatives(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, one of each component: that with the least doc_id, then the least text.

    Rows without shingles all stay.  Each row is judged by its own text, also where rows
    share a doc_id: they are told apart by a hash of the text.  Of rows that agree in
    doc_id and text one stays.
    """
    doc, mark = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)), F.xxhash64("text")
    sets, roots = _linked(docs.select(doc.alias("doc"), mark.alias("mark"), "text"), size, percent)
    of = sets.filter("n > 0").select("doc", "mark", "print").join(roots, F.col("print") == F.col("node"), "left")
    of = written(of.select("doc", "mark", F.coalesce("root", "print").alias("comp")), "jaccard-found")
    tops = of.groupBy("comp").agg(
        F.min(F.struct("doc", "mark")).alias("top"), F.max(F.struct(F.bitwise_not("doc").alias("not"), "mark")).alias("end")
    )
    tops = written(tops.select("comp", "top.*", F.col("end.mark").alias("end")), "jaccard-tops")
    rows = docs.select(F.struct(*docs.columns).alias("row"), doc.alias("of"), mark.alias("by"))

    def same(other: DataFrame):
        return (F.col("of") == other["doc"]) & (F.col("by") == other["mark"])

    stay, equal = tops.filter("mark = end").select("doc", "mark"), tops.filter("mark <> end")
    if not equal.isEmpty():
        # Unlike texts of the least doc_id of a component: the least of them stays.
        each = of.join(equal.select("comp", "doc"), ["comp", "doc"]).distinct()
        texts = rows.join(each, same(each)).select("comp", "doc", "mark", F.col("row.text").alias("text"))
        least = texts.groupBy("comp").agg(F.min_by(F.struct("doc", "mark"), "text").alias("least"))
        stay = stay.unionByName(least.select("least.*"))
    stay = written(stay, "jaccard-stay")
    gone = of.select("doc", "mark").join(stay, ["doc", "mark"], "left_anti")
    many = of.groupBy("doc", "mark").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc", "mark")
    gone = gone.unionByName(many).distinct()
    out = rows.join(gone, same(gone), "left_anti").select("row")
    many = written(many, "jaccard-many")
    if not many.isEmpty():
        kept = many.join(stay, ["doc", "mark"], "left_semi")
        again = rows.join(kept, same(kept), "left_semi")
        first = again.groupBy("of", "by").agg(F.min_by("row", F.col("row.text")).alias("row"))
        out = out.unionByName(first.select("row"))
    return out.select("row.*")
