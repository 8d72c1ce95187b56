"""Sums per key taken up from an earlier state, for input that comes in batches.

The state of the earlier batches enters as one row per key ahead of the new
rows, so one ordered scan gives both the rows to emit and the state to keep,
and heavy keys are split as in any other scan.  Call it once per arrived batch,
for example for each micro-batch of a stream whose heavy keys outgrow one task,
and write the state to a new folder each time.  A batch costs its rows plus the
number of keys; with many keys and small batches the stateful streams are
cheaper.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keyed import is_clear
from tidemark.plans import Layout, Pass, ordered_scan

SEED = "seed"


def resume_sums(
    numbers: DataFrame, state: DataFrame | None, layout: Layout, n: str = "n"
) -> DataFrame:
    """(keys, order, n, total, size, latest, seed) of the new rows and the earlier state.

    Rows must follow all earlier ones in their order.  The result feeds
    `emitted` and `state_after`; write it, or persist it, before using both.
    """
    rows = numbers.select(
        *layout.keys,
        *layout.order,
        n,
        F.lit(0).cast("bigint").alias("held"),
        F.lit(None).cast("bigint").alias("latest"),
        F.lit(False).alias(SEED),
    )
    if state is not None:
        rows = rows.unionByName(_seeds(state, numbers, layout, n))
    # An earlier sum may be -1 without being a clear.
    cleared = ~F.col(SEED) & is_clear(n)
    added = F.when(cleared, 0)
    sums = {
        "total": added.otherwise(F.col(n)),
        "size": added.when(F.col(SEED), F.col("held")).otherwise(1),
    }
    return ordered_scan(rows, layout, Pass(sums, restart=cleared)).drop("held")


def _seeds(state, numbers, layout, n):
    first, *rest = layout.order
    types = dict(numbers.dtypes)
    low = layout.low if layout.low is not None else 0
    return state.select(
        *layout.keys,
        F.lit(low - 1).cast(types[first]).alias(first),
        *[F.lit(None).cast(types[c]).alias(c) for c in rest],
        F.col("total").alias(n),
        F.col("size").alias("held"),
        "latest",
        F.lit(True).alias(SEED),
    )


def emitted(rows: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """What the new numbers emit: (keys, order, n, total, size)."""
    new = rows.filter(~F.col(SEED) & ~is_clear(n))
    return new.select(*layout.keys, *layout.order, n, "total", "size")


def state_after(rows: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """State of every key after the batch: (keys, total, size, latest)."""
    position = layout.position()
    emits = F.col(SEED) & F.col("latest").isNotNull() | ~F.col(SEED) & ~is_clear(n)
    sent = F.when(F.col(SEED), F.col("latest")).otherwise(F.col("total"))
    return rows.groupBy(*layout.keys).agg(
        F.max_by("total", position).alias("total"),
        F.max_by("size", position).alias("size"),
        F.max_by(sent, F.when(emits, position)).alias("latest"),
    )
