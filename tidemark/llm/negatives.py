"""Hard negatives for embedding training, by cover trees.

Components become whole numbers, floor(scale * x); a row's score is its inner product with
the anchor.  An anchor's positives are its best rows of the same label.  For each of them
the best rows of other labels are wanted whose scores lie in a window below the positive's.

Rows of one label are dealt into shards of bounded height, and each shard becomes a cover
tree.  A further component, sqrt(M * M - |x| * |x|) with M the longest row of the shard,
gives all rows the same norm, so that near in that space means a high product for every
anchor, whose own further component is 0.  On each level a node's rows go to the first
centre that lies within the level's radius, which halves from level to level; a node keeps
its covering radius, the distance of its farthest row.  Rows too scattered to form groups
stay together in one leaf.  With q the anchor and c the centre, all products below the
node lie within q * c +- |q| * radius.

Anchors come in blocks and descend best first, by that upper bound.  Nodes that lie wholly
outside every window still open, or below what is found already, are skipped with all their
rows.  In the leaves products are taken exactly: in doubles, which hold whole numbers to
2**53, or as whole numbers of any length where they could pass that.  Every shard gives
short lists, and those are merged by Spark.

Shards, blocks and lists are bounded, whatever share of the rows one label has; trees are
written once and serve both searches.

Defined results: rows with a null label or id, a null vector, or null or non-finite
components take no part.  Vectors of another length than the anchor's are no candidates.
Ties go to the smaller id, then repeated rows count each: an anchor never meets its own id.
An id that is repeated among the anchors is one anchor, that of the least (vector, label).
Fewer rows give shorter lists, an empty table none.  Scores past 64 bits fail the query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import written
from tidemark.llm.topk import usable, whole_numbers

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: Least share of the positive's score, in percent; the most is 100.
LEAST_PERCENT = 80
#: Rows of a tree, anchors of a block, and rows that a node of a tree keeps unsplit.
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 8192, 512, 64
#: By how much radii shrink from level to level, and how many centres in a row that cover
#: no row but themselves end the search for groups in a node.
SHRINK, SCATTERED = 2, 16
#: Bounds are taken in doubles: so much of their size is added for rounding.
SLACK = 1e-9


# --- trees ------------------------------------------------------------------


@dataclass
class CoverTree:
    """Rows in tree order; node i covers rows first[i]:last[i], its children child[i]:child_end[i].

    A leaf has no children.  The centre of a node is one of its rows.
    """

    ids: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    last: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    child_end: np.ndarray

    def __post_init__(self) -> None:
        self.centres = self.rows[self.centre].astype(np.float64)


def _augmented(rows: np.ndarray) -> np.ndarray:
    """The rows with one more component, so that all have the same norm."""
    norms = (rows * rows).sum(axis=1)
    return np.hstack([rows, np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))[:, None]])


def build(ids: np.ndarray, rows: np.ndarray) -> CoverTree:
    """A cover tree of at least one row, level by level."""
    space = _augmented(rows.astype(np.float64))
    order: list[np.ndarray] = [np.arange(len(ids))]
    # Per node: begin and end in tree order, centre, level radius, covering radius.
    begin, end, centre, radius = [0], [len(ids)], [0], [0.0]
    child, child_end = [0], [0]
    norm = float((space[0] ** 2).sum())
    far = np.sqrt(np.maximum(2 * (norm - space @ space[0]), 0.0))
    radius[0], level = float(far.max()), [(0, float(far.max()))]
    place = order[0]
    while level:
        deeper = []
        for node, span in level:
            inside = place[begin[node] : end[node]]
            if len(inside) <= LEAF_ROWS or radius[node] <= SLACK * norm:
                continue
            reach = span / SHRINK
            child[node], at, rest, parts = len(begin), begin[node], inside, []
            nearest, alone = centre[node], 0
            while len(rest):
                # |x - c| by one product: all rows have the same norm.
                distance = np.sqrt(np.maximum(2 * (norm - space[rest] @ space[nearest]), 0.0))
                near = distance <= reach
                near[rest == nearest] = True
                alone = alone + 1 if np.count_nonzero(near) == 1 else 0
                if alone == SCATTERED:  # no groups left to be found: one leaf holds the rest
                    near[:] = True
                taken = rest[near]
                parts.append(taken)
                begin.append(at), end.append(at + len(taken)), centre.append(int(nearest))
                radius.append(float(distance[near].max())), child.append(0), child_end.append(0)
                if alone < SCATTERED:
                    deeper.append((len(begin) - 1, reach))
                at, rest = at + len(taken), rest[~near]
                if len(rest):
                    nearest = rest[0]
            place[begin[node] : end[node]] = np.concatenate(parts)
            child_end[node] = len(begin)
        level = deeper
    return CoverTree(
        ids[place], rows[place], np.array(begin), np.array(end),
        np.argsort(place)[np.array(centre)], np.array(radius), np.array(child), np.array(child_end),
    )


TREE = "label int, shard bigint, dim int, peak double, ids binary, matrix binary, nodes binary, radius binary"


def _tree_rows(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("vec_id", ignore_index=True)
    matrix = np.vstack(rows["vector"]).astype(np.int64)
    tree = build(rows["vec_id"].to_numpy(np.int64), matrix)
    nodes = np.stack([tree.first, tree.last, tree.centre, tree.child, tree.child_end])
    packed = {
        "label": rows["label"].iloc[0],
        "shard": rows["shard"].iloc[0],
        "dim": matrix.shape[1],
        "peak": float(np.abs(matrix.astype(np.float64)).max(initial=0)),
        "ids": tree.ids.tobytes(),
        "matrix": tree.rows.tobytes(),
        "nodes": nodes.astype(np.int32).tobytes(),
        "radius": tree.radius.tobytes(),
    }
    return pd.DataFrame([packed])


def _unpacked(row) -> CoverTree:
    ids = np.frombuffer(row.ids, np.int64)
    nodes = np.frombuffer(row.nodes, np.int32).reshape(5, -1)
    rows = np.frombuffer(row.matrix, np.int64).reshape(len(ids), row.dim)
    first, last, centre, child, child_end = nodes
    return CoverTree(ids, rows, first, last, centre, np.frombuffer(row.radius), child, child_end)


# --- search -----------------------------------------------------------------


@dataclass
class Wanted:
    """The k best rows of a tree whose products lie in low..high; ties to smaller ids."""

    low: float
    high: float
    k: int
    found: list  # heap of (product, -id)

    def open(self, least: float, most: float) -> bool:
        """Whether rows with products in least..most may belong here."""
        if most < self.low or least > self.high:
            return False
        return len(self.found) < self.k or most >= self.found[0][0]

    def open_all(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        low = max(self.low, self.found[0][0]) if len(self.found) == self.k else self.low
        return (most >= low) & (least <= self.high)

    def offer(self, products: np.ndarray, ids: np.ndarray) -> None:
        fits = (products >= self.low) & (products <= self.high)
        if len(self.found) == self.k:
            fits &= products >= self.found[0][0]
        some = np.flatnonzero(fits)
        if len(some) > self.k:
            least = np.partition(products[some], len(some) - self.k)[len(some) - self.k]
            some = some[products[some] >= least]
        for product, name in zip(products[some].tolist(), ids[some].tolist(), strict=True):
            if len(self.found) < self.k:
                heapq.heappush(self.found, (product, -name))
            else:
                heapq.heappushpop(self.found, (product, -name))


def descend(tree: CoverTree, anchor: int, query: np.ndarray, exact: type, wanted: list[Wanted]) -> int:
    """Fills `wanted`; returns how many rows were looked at, centres included.

    `exact` is the type in which products are exact, float or object.
    """
    near = query.astype(np.float64)
    wide = float(np.sqrt((near * near).sum())) * (1 + SLACK)
    query = query.astype(exact)

    def limits(begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        middle = tree.centres[begin:end] @ near
        spread = wide * tree.radius[begin:end] + SLACK * np.abs(middle) + SLACK
        return middle - spread, middle + spread

    looked, heap = 1, []
    least, most = limits(0, 1)
    heapq.heappush(heap, (-float(most[0]), 0, float(least[0])))
    while heap:
        top, node, bottom = heapq.heappop(heap)
        if not any(w.open(bottom, -top) for w in wanted):
            continue
        begin, end = int(tree.child[node]), int(tree.child_end[node])
        if end > begin:
            least, most = limits(begin, end)
            looked += end - begin
            able = np.zeros(end - begin, bool)
            for w in wanted:
                able |= w.open_all(least, most)
            for i in np.flatnonzero(able).tolist():
                heapq.heappush(heap, (-float(most[i]), begin + i, float(least[i])))
            continue
        inside = slice(tree.first[node], tree.last[node])
        others = tree.ids[inside] != anchor
        products = (tree.rows[inside].astype(exact, copy=False) @ query)[others]
        looked += len(products)
        for w in wanted:
            w.offer(products, tree.ids[inside][others])
    return looked


FOUND = "anchor_id bigint, slot int, score bigint, vec_id bigint"


def _searched(k: int):
    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows hold a tree and a block of anchors with the windows that each asks for."""
        for batch in batches:
            for row in batch.itertuples(index=False):
                tree = _unpacked(row)
                anchors = np.frombuffer(row.q_ids, np.int64)
                queries = np.frombuffer(row.q_matrix, np.int64).reshape(len(anchors), row.dim)
                peak = float(np.abs(queries.astype(np.float64)).max(initial=0)) * row.peak * max(row.dim, 1)
                exact = np.float64 if peak < 2.0**53 else object
                if exact is np.float64:
                    tree.rows = tree.rows.astype(np.float64)
                out = []
                for anchor, query, own, lows, highs in zip(
                    anchors.tolist(), queries, row.q_labels, row.q_lows, row.q_highs, strict=True
                ):
                    if (own == row.label) != row.same:
                        continue
                    wanted = [Wanted(a, b, k, []) for a, b in zip(lows, highs, strict=True)]
                    descend(tree, anchor, query, exact, wanted)
                    out += [(anchor, i, int(p), -n) for i, w in enumerate(wanted) for p, n in w.found]
                yield pd.DataFrame(out, columns=["anchor_id", "slot", "score", "vec_id"])

    return searched


def _block_rows(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("vec_id", ignore_index=True)
    packed = {
        "block": rows["block"].iloc[0],
        "dim": rows["dim"].iloc[0],
        "q_ids": rows["vec_id"].to_numpy(np.int64).tobytes(),
        "q_matrix": np.vstack(rows["vector"]).astype(np.int64).tobytes() if rows["dim"].iloc[0] else b"",
        "q_labels": rows["label"].tolist(),
        "q_lows": [list(x) for x in rows["lows"]],
        "q_highs": [list(x) for x in rows["highs"]],
    }
    return pd.DataFrame([packed])


BLOCK = (
    "block bigint, dim int, q_ids binary, q_matrix binary, q_labels array<int>, "
    "q_lows array<array<double>>, q_highs array<array<double>>"
)


def search(asked: DataFrame, trees: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor_id, slot, score, vec_id, place): for each window of each anchor the k best rows.

    `asked` has vec_id, vector, label and the windows as arrays lows and highs.  With `same`
    only trees of the anchor's label are searched, else all others.  `slot` numbers the
    windows, `place` the rows of one from 1.
    """
    asked = asked.withColumn("dim", F.size("vector"))
    # A block is of one label where it meets the trees of that label only.
    apart = [F.col("label")] if same else []
    counts = asked.agg(F.count("*").alias("rows")).first()["rows"]
    parts = max(1, -(-counts // BLOCK_ROWS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(parts)))
    blocks = asked.groupBy("block", "dim", *apart).applyInPandas(_block_rows, BLOCK)
    if same:
        blocks = blocks.withColumn("label", F.element_at("q_labels", 1))
    # Every block meets every tree once, dealt over as many tasks as there are trees and blocks.
    tiles = trees.select("label", "shard", "dim", "peak", "ids", "matrix", "nodes", "radius", F.lit(same).alias("same"))
    tiles = tiles.join(blocks, ["dim", "label"] if same else ["dim"])
    tiles = tiles.repartition(F.xxhash64("label", "shard", "block"))
    lists = tiles.mapInPandas(_searched(k), FOUND)
    merged = lists.groupBy("anchor_id", "slot", F.pmod(F.xxhash64("vec_id"), F.lit(16)).alias("part"))
    order = F.struct((-F.col("score")).alias("order"), F.col("vec_id"))
    best = merged.agg(F.slice(F.array_sort(F.collect_list(order)), 1, k).alias("best"))
    best = best.groupBy("anchor_id", "slot").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    found = best.select("anchor_id", "slot", F.posexplode("best").alias("at", "row"))
    return found.select(
        "anchor_id", "slot", (-F.col("row.order")).alias("score"), F.col("row.vec_id").alias("vec_id"),
        (F.col("at") + 1).cast("int").alias("place"),
    )


def plant(rows: DataFrame) -> DataFrame:
    """The cover trees of (vec_id, label, vector): a row for each label, length and shard."""
    rows = rows.withColumn("dim", F.size("vector")).filter("dim > 0")
    sizes = rows.groupBy("label", "dim").agg(F.count("*").alias("rows"))
    shards = F.ceil(F.col("rows") / SHARD_ROWS)
    # Repeated rows are dealt apart as well.
    placed = rows.join(sizes, ["label", "dim"]).withColumn(
        "shard", F.pmod(F.xxhash64("vec_id", F.rand(seed=11)), shards).cast("bigint")
    )
    placed = placed.select("label", "shard", "dim", "vec_id", "vector")
    return placed.groupBy("label", "shard", "dim").applyInPandas(_tree_rows, TREE)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `vectors` has vec_id, embedding and label; `is_anchor` marks the rows that are anchors.
    """
    known = F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.filter(usable() & known).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("int").alias("label"),
        whole_numbers(scale).alias("vector"),
        is_anchor.alias("asks"),
    )
    trees = written(plant(rows.select("vec_id", "label", "vector")), "negatives-trees")
    anchors = rows.filter("asks").groupBy("vec_id").agg(F.min(F.struct("vector", "label")).alias("row"))
    anchors = anchors.select("vec_id", "row.vector", "row.label")
    every = F.array(F.lit(float("inf")))
    asked = anchors.withColumns({"lows": F.array(F.lit(float("-inf"))), "highs": every})
    best = search(asked, trees, True, positives)
    best = best.select(
        F.col("anchor_id").alias("vec_id"), "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    best = written(best, "negatives-positives")
    # Products are whole, so the window's lower end is the next whole number.
    low = F.ceil(F.col("positive_score").cast("decimal(20,0)") * least_percent / 100).cast("double")
    windows = best.groupBy("vec_id").agg(
        F.array_sort(F.collect_list(F.struct("place", low.alias("low"), F.col("positive_score").cast("double").alias("high")))).alias("all")
    )
    asked = anchors.join(windows, "vec_id").withColumns({"lows": F.col("all.low"), "highs": F.col("all.high")}).drop("all")
    hard = search(asked, trees, False, negatives)
    hard = hard.select(
        F.col("anchor_id").alias("vec_id"), (F.col("slot") + 1).alias("place"),
        F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    return hard.join(best, ["vec_id", "place"]).select(
        F.col("vec_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
