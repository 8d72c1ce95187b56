"""Exact top-k search by inner product, as matrix products of tiles.

Queries and candidates are packed into matrices of bounded height.  Every query block
meets every shard in one task per tile: a matrix product, then a partial selection of
each query's best k.  The short lists of a query are merged in a tree.

Components are turned into whole numbers first, floor(scale * x), and products are
taken in doubles where no sum can pass 2**53, else in 64-bit integers (which wrap only
where the true score does not fit them): scores are exact.

Defined results: vectors that are null, or hold null or non-finite components, take no
part, nor do rows without an id.  Vectors of different lengths meet only their own kind.  A query never finds rows
with its own id.  Ties go to the smaller id; repeated rows each count.  Fewer than k
candidates give fewer ranks; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERY_ROWS = 2048
SHARD_ROWS = 8192
#: Lists of a query that one step of the merge brings together.
FAN_IN = 16


def usable(embedding: str = "embedding") -> Column:
    x = F.col(embedding)
    wrong = F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    )
    return x.isNotNull() & ~F.coalesce(wrong, F.lit(True))


def whole_numbers(scale: int, embedding: str = "embedding") -> Column:
    return F.transform(embedding, lambda v: F.floor(v.cast("double") * scale))


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    block = {
        "block": rows["block"].iloc[0],
        "dim": rows["dim"].iloc[0],
        "ids": rows["vec_id"].to_numpy(np.int64).tobytes(),
        "matrix": np.vstack(rows["vector"]).astype(np.int64).tobytes() if rows["dim"].iloc[0] else b"",
    }
    return pd.DataFrame([block])


def blocks(vectors: DataFrame, count: int) -> DataFrame:
    """(block, dim, ids, matrix): `vectors` dealt evenly into about `count` matrices."""
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector", "salt"), F.lit(count)))
    schema = "block bigint, dim int, ids binary, matrix binary"
    return dealt.select("block", "dim", "vec_id", "vector").groupBy("block", "dim").applyInPandas(_pack, schema)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best of one query: highest score, then smallest id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        chosen = np.flatnonzero(scores >= least)
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))][:k]


def _tile(k: int):
    def tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                queries, rows = (np.frombuffer(x, np.int64) for x in (row.q_ids, row.ids))
                a = np.frombuffer(row.q_matrix, np.int64).reshape(len(queries), row.dim)
                b = np.frombuffer(row.matrix, np.int64).reshape(len(rows), row.dim)
                peak = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(row.dim, 1)
                exact = np.float64 if peak < 2.0**53 else np.int64
                a, b = a.astype(exact), b.astype(exact)
                for at in range(0, len(queries), 256):
                    part = (a[at : at + 256] @ b.T).astype(np.int64)
                    out = []
                    for q, scores in zip(queries[at : at + 256], part, strict=True):
                        others = np.flatnonzero(rows != q)
                        best = others[_best(scores[others], rows[others], k)]
                        out.append((q, row.shard, scores[best].tolist(), rows[best].tolist()))
                    yield pd.DataFrame(out, columns=["query_id", "shard", "scores", "ids"])

    return tiles


def _merge(lists: DataFrame, k: int, shards: int) -> DataFrame:
    """One list per query: groups of `FAN_IN` neighbouring shards are merged at a time."""
    pairs = F.transform(
        F.arrays_zip("scores", "ids"),
        lambda x: F.struct((-x["scores"]).alias("order"), x["ids"].alias("vec_id")),
    )
    lists = lists.select("query_id", "shard", pairs.alias("best"))
    while True:
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN))
        merged = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k)
        lists = lists.groupBy("query_id", "shard").agg(merged.alias("best"))
        shards = -(-shards // FAN_IN)
        if shards <= 1:
            return lists


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best among all other rows.

    `vectors` has vec_id and embedding; `is_query` marks the rows that are queries.
    Rows with equal ids are one query (the least vector's).
    """
    taken = vectors.filter(usable() & F.col("vec_id").isNotNull()).select("vec_id", whole_numbers(scale).alias("vector"), is_query.alias("asks"))
    taken = taken.withColumn("dim", F.size("vector"))
    # Repeated rows would meet in one block if their hash were that of the vector alone.
    taken = taken.withColumn("salt", F.rand(seed=7))
    sizes = taken.agg(F.count("*").alias("rows"), F.count_if("asks").alias("queries")).first()
    shards = max(1, -(-sizes["rows"] // SHARD_ROWS))
    parts = max(1, -(-sizes["queries"] // QUERY_ROWS))
    asked = taken.filter("asks").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = asked.select("*", F.size("vector").alias("dim"), F.lit(0.0).alias("salt"))
    query_blocks = blocks(asked, parts).withColumnsRenamed(
        {"block": "part", "ids": "q_ids", "matrix": "q_matrix"}
    )
    # A copy of each query block for each shard: the tiles of the product.
    tiles = query_blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")))
    tiles = tiles.join(blocks(taken, shards).withColumnRenamed("block", "shard"), ["shard", "dim"])
    lists = tiles.select("part", "shard", "dim", "q_ids", "q_matrix", "ids", "matrix").mapInPandas(
        _tile(k), "query_id bigint, shard bigint, scores array<bigint>, ids array<bigint>"
    )
    best = _merge(lists, k, shards)
    ranked = best.select("query_id", F.posexplode("best").alias("at", "found"))
    return ranked.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("found.vec_id").alias("vec_id"),
        (-F.col("found.order")).cast("bigint").alias("score"),
    )
