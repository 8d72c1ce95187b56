"""Which keys are too heavy for one task, and how their rows are split.

Work in arrival order needs the rows of a key side by side, so one key is one
window group and one task.  That is the best plan for the many light keys and
a bad one for a key that holds, say, a third of the table.  `measure` finds
the heavy ones; `segmented_scan` gives those a chunk number per row.

Heavy keys are looked for by hash slot, not by key: however many keys there
are, the count table has no more rows than slots, so map tasks shrink their part
to that size before the shuffle.  There are as many slots as keep the mean slot well
below the limit, which is the same for every input; only the heavy ones, one per
`group_rows` rows at most, reach the driver.  A slot counts at least as many rows as any key in it, so no heavy key is missed.
Light keys that share a slot with a heavy one are split along with it, which
costs a little time and changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Slots at least, and how many mean slots the limit of a heavy one is at least.
SLOTS = 1 << 16
HEAVY = 8
# Bins of the histogram, and chunks per key at most, as powers of two.
BIN_BITS = 12
CHUNK_BITS = 20
# Heavy rows are sparse when their order spans more than this multiple of them.
SPARSE = 16
# Groups below this many rows are never worth splitting.
GROUP_ROWS = 1 << 21


def names(columns: str | Sequence[str]) -> tuple[str, ...]:
    return (columns,) if isinstance(columns, str) else tuple(columns)


@dataclass(frozen=True)
class Layout:
    """Key and order columns of a stream, and its heavy hash slots.

    No keys means that all rows are one stream; prefer that to a constant key.
    `order` must be unique within a key; its first column must be integral and
    is cut into chunks of 2**bits for the keys of the heavy slots.  `low` is the
    least value of that column, where it was measured and there are rows.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    heavy: tuple[int, ...] = ()
    bits: int = 0
    low: int | None = None
    slots: int = SLOTS

    def is_heavy(self) -> Column:
        if not self.keys:
            return F.lit(True)
        return slot(self.keys, self.slots).isin(list(self.heavy))

    def position(self) -> Column:
        """The order as one comparable column."""
        return F.col(self.order[0]) if len(self.order) == 1 else F.struct(*self.order)

    def chunk(self) -> Column:
        """Chunk number; never null, so that joining on it adds no null filter.

        Such a filter would reach the scan on one side of the join and keep
        Spark from reading one exchange for both.
        """
        position = F.col(self.order[0]).cast("bigint")
        return F.coalesce(F.shiftright(position, self.bits), F.lit(0))


def slot(keys: Sequence[str], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)) if keys else F.lit(0).cast("bigint")


def slots_for(rows: int, group_rows: int) -> int:
    """A power of two, so that `HEAVY` mean slots are no more than `group_rows` rows.

    Small inputs that are split for want of parts keep to the least number.
    """
    wanted = HEAVY * rows // max(group_rows, GROUP_ROWS)
    return max(SLOTS, 1 << wanted.bit_length())


def measure(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    group_rows: int = GROUP_ROWS,
    min_parts: int = 1,
) -> Layout:
    """Layout for `df`, from a count and one pass over its key and first order column.

    Runs Spark jobs.  A slot is heavy when it holds more rows than `group_rows`.

    A single order column is unique within a key, so chunks that span `group_rows`
    values hold no more rows than that.  Where the heavy rows are too sparse for
    it, as with timestamps, or have several order columns, a second job takes a
    histogram of the first one, and chunks become so wide that one in the
    densest part holds about `group_rows` rows.

    `min_parts` lowers `group_rows` for small inputs, so that a stream of all
    rows is cut into about that many chunks at least.
    """
    keys, order = names(keys), names(order)
    total = df.count()
    group_rows = max(1, min(group_rows, total // min_parts))
    slots = slots_for(total, group_rows)
    rows = df.select(
        slot(keys, slots).alias("slot"), F.col(order[0]).cast("bigint").alias("position")
    )
    counts = rows.groupBy("slot").agg(
        F.count("*").alias("n"), F.min("position").alias("low"), F.max("position").alias("high")
    )
    # The least position of all rows, and the heavy slots only.
    least = F.min(F.col("low")).alias("low")
    heavy_rows = F.collect_list(F.when(F.col("n") > group_rows, F.struct("slot", "n", "low", "high")))
    low, heavy = counts.agg(least, heavy_rows.alias("heavy")).first()
    if not heavy:
        return Layout(keys, order, low=low, slots=slots)
    found = tuple(sorted(row["slot"] for row in heavy))
    span = max(row["high"] for row in heavy) - min(row["low"] for row in heavy) + 1
    unique = len(order) == 1
    width = group_rows
    if not unique or span > SPARSE * sum(row["n"] for row in heavy):
        measured = _measured_width(rows, found, span, group_rows)
        width = max(measured, group_rows if unique else 1)
    return Layout(keys, order, found, width.bit_length() - 1, low, slots)


def _measured_width(rows: DataFrame, slots: tuple[int, ...], span: int, group_rows: int) -> int:
    bin_bits = max(0, span.bit_length() - BIN_BITS)
    densest = (
        rows.filter(F.col("slot").isin(list(slots)))
        .groupBy(F.shiftright("position", bin_bits).alias("bin"))
        .count()  # at most 2**BIN_BITS + 1 rows
        .agg(F.max("count").alias("n"))
        .first()["n"]
    )
    return max((group_rows << bin_bits) // densest, span >> CHUNK_BITS)
