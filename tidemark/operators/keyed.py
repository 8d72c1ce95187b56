"""Sums, averages and states per key that a marker in the stream clears.

Input everywhere: one row per number, with the key and order columns of the
layout, and `n`, where -1 clears what the key holds so far.  A sum past 64 bits
fails the query (ANSI mode) instead of wrapping round.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.tokens import AVERAGE_LABEL, CLEAR, STATE_KEY
from tidemark.plans import Layout, Pass, ordered_scan
from tidemark.plans.layout import names
from tidemark.session import scratch_folder

# The names under which the states of a key are published.
VALUE_STATE = "value-query"
LIST_STATE = "list-query"
MAP_STATE = "map-query"
REDUCING_STATE = "reduce-query"
KEYED_STATE = "keyed-query"


def is_clear(n: str = "n") -> Column:
    return F.col(n) == CLEAR


def _unless_clear(n: str, value: Column) -> Column:
    return F.when(is_clear(n), 0).otherwise(value)


def _needed(numbers: DataFrame, layout: Layout, n: str) -> DataFrame:
    return numbers.select(*layout.keys, *layout.order, n)


def resettable_sum(numbers: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """Each number with the sum since the last clear: (keys, order, n, total)."""
    total = Pass({"total": _unless_clear(n, F.col(n))}, restart=is_clear(n))
    rows = ordered_scan(_needed(numbers, layout, n), layout, total)
    return rows.filter(~is_clear(n))


def running_average(numbers: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """Average since the last clear, from the second number on: (keys, order, avg)."""
    rows = ordered_scan(_needed(numbers, layout, n), layout, _since_clear(n))
    average = F.col("total").cast("double") / F.col("place").cast("double")
    return rows.filter(~is_clear(n) & (F.col("place") >= 2)).select(
        *layout.keys, *layout.order, average.alias("avg")
    )


def pair_average(numbers: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """Average of every two numbers; what is left of a pair at a clear is dropped.

    (keys, order, avg) with the order of the second number.
    """
    places = Pass(
        {"place": _unless_clear(n, F.lit(1))},
        restart=is_clear(n),
        previous={"other": F.col(n)},
    )
    rows = ordered_scan(_needed(numbers, layout, n), layout, places)
    pairs = rows.filter(~is_clear(n) & (F.col("place") % 2 == 0))
    total = F.col(n) + F.col("other")
    return pairs.select(*layout.keys, *layout.order, (total.cast("double") / 2).alias("avg"))


def _since_clear(n: str) -> Pass:
    """Sum and place of each number since the last clear before it."""
    sums = {"total": _unless_clear(n, F.col(n)), "place": _unless_clear(n, F.lit(1))}
    return Pass(sums, restart=is_clear(n))


#: Keys whose ends may be broadcast: a place or two and the key of each.
BROADCAST_KEYS = 1 << 18


def _same_keys(left: DataFrame, right: DataFrame, layout: Layout) -> Column:
    equal = [left[k].eqNullSafe(right[k]) for k in layout.keys]
    return reduce(Column.__and__, equal, F.lit(True))


def _ends(numbers: DataFrame, layout: Layout, n: str, latest: bool) -> DataFrame:
    """(keys, cleared, given): the places of each key's last clear and last number.

    With `latest` also `before`, the last clear ahead of the last number.  Maxima are
    reduced before the shuffle; one row per key is written.
    """
    position, clear = layout.position(), is_clear(n)
    ends = numbers.groupBy(*layout.keys).agg(
        F.max(F.when(clear, position)).alias("cleared"), F.max(F.when(~clear, position)).alias("given")
    )
    ends = _kept(ends)
    if not latest:
        return ends
    if ends.filter("cleared > given").isEmpty():
        return ends.withColumn("before", F.col("cleared"))
    rows = _beside(numbers, ends, layout)
    ahead = F.when(clear & (position < F.col("given")), position)
    before = rows.groupBy(*layout.keys).agg(
        F.max("cleared").alias("cleared"), F.max("given").alias("given"), F.max(ahead).alias("before")
    )
    return _kept(before)


def _kept(rows: DataFrame) -> DataFrame:
    path = scratch_folder(rows.sparkSession, "ends")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _beside(numbers: DataFrame, ends: DataFrame, layout: Layout) -> DataFrame:
    """The numbers with the ends of their keys.

    Few ends are broadcast, and then no row is shuffled; many are hashed, so nothing is
    sorted either way.
    """
    few = ends.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    ends = F.broadcast(ends) if few else ends.hint("shuffle_hash")
    rows = numbers.join(ends, _same_keys(numbers, ends, layout))
    return rows.select(*[numbers[c] for c in numbers.columns], *[c for c in ends.columns if c not in layout.keys])


def _totals(numbers: DataFrame, layout: Layout, n: str, latest: bool) -> DataFrame:
    """(keys, sum): what each key holds since its last clear, null for nothing.

    With `latest` also `last`, the last sum that the key emitted.  Two passes of
    aggregates, or three where a key ends with a clear: no row is sorted.
    """
    numbers = _needed(numbers, layout, n)
    ends = _ends(numbers, layout, n, latest)
    rows, position, given = _beside(numbers, ends, layout), layout.position(), ~is_clear(n)
    sums = [F.sum(F.when(given & _behind("cleared", position), F.col(n))).alias("sum")]
    if latest:
        sent = given & _behind("before", position) & (position <= F.col("given"))
        sums.append(F.sum(F.when(sent, F.col(n))).alias("last"))
    return rows.groupBy(*layout.keys).agg(*sums)


def _behind(place: str, position: Column) -> Column:
    return F.col(place).isNull() | (position > F.col(place))


def value_state(numbers: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """Current sum of every key; 0 right after a clear: (keys, value)."""
    sums = _totals(numbers, layout, n, latest=False)
    return sums.select(*layout.keys, F.coalesce("sum", F.lit(0)).alias("value"))


def list_state(numbers: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """Numbers since the last clear in order, one row each: (keys, pos, n), pos from 0.

    Only those are put in order.
    """
    numbers = _needed(numbers, layout, n)
    rows = _beside(numbers, _ends(numbers, layout, n, latest=False), layout)
    live = rows.filter(~is_clear(n) & _behind("cleared", layout.position())).select(*numbers.columns)
    placed = ordered_scan(live, layout, Pass({"place": F.lit(1)}))
    return placed.select(*layout.keys, (F.col("place") - 1).alias("pos"), n)


def reducing_state(numbers: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """Sum since the last clear; no row for a key that holds nothing: (keys, value)."""
    sums = _totals(numbers, layout, n, latest=False).filter("sum IS NOT NULL")
    return sums.select(*layout.keys, F.col("sum").alias("value"))


def map_state(numbers: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """The one map entry of a key, named after it, with its sum: (keys, map_key, value)."""
    sums = reducing_state(numbers, layout, n)
    return sums.select(*layout.keys, map_key(layout).alias("map_key"), "value")


def map_key(layout: Layout) -> Column:
    if not layout.keys:
        return F.lit(STATE_KEY)
    return F.concat_ws(",", *[F.col(k).cast("string") for k in layout.keys])


def keyed_latest(numbers: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """Last sum emitted for every key; a clear emits nothing: (keys, value)."""
    sums = _totals(numbers, layout, n, latest=True).filter("last IS NOT NULL")
    return sums.select(*layout.keys, F.col("last").alias("value"))


def labelled_inputs(numbers: DataFrame, n: str = "n") -> DataFrame:
    """What the summing job with labels emits: the input under a label, not the sum."""
    return numbers.filter(~is_clear(n)).withColumn("label", F.lit(AVERAGE_LABEL))


def last_input(
    numbers: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str] = "seq",
    n: str = "n",
) -> DataFrame:
    """Last number per key, clears left out: (keys, value).  Reduced before the shuffle."""
    latest = F.max_by(n, Layout(names(keys), names(order)).position())
    return numbers.filter(~is_clear(n)).groupBy(*names(keys)).agg(latest.alias("value"))


def state_snapshot(numbers: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """All five states of every key: (state_name, keys, pos, map_key, value, found).

    A state that a key does not hold gives one row with found = false and no
    value.  List elements are rows, never one array per key.
    """
    return published(_totals(numbers, layout, n, latest=True), list_state(numbers, layout, n), layout, n)


def published(sums: DataFrame, elements: DataFrame, layout: Layout, n: str = "n") -> DataFrame:
    """The rows of `state_snapshot` from (keys, sum, last) and the lists (keys, pos, n)."""
    nothing = F.lit(None).cast("bigint")
    no_entry = F.lit(None).cast("string")

    def state(name: str, value: Column, entry: Column = no_entry) -> Column:
        found = value.isNotNull()
        return F.struct(
            F.lit(name).alias("state_name"),
            F.when(found, entry).alias("map_key"),
            value.alias("value"),
            found.alias("found"),
        )

    held = F.col("sum")
    states = F.array(
        state(VALUE_STATE, F.coalesce(held, F.lit(0))),
        state(MAP_STATE, held, map_key(layout)),
        state(REDUCING_STATE, held),
        state(KEYED_STATE, F.col("last")),
    )
    with_list = F.concat(states, F.array(state(LIST_STATE, nothing)))
    scalars = sums.select(
        *layout.keys, F.explode(F.when(held.isNull(), with_list).otherwise(states)).alias("s")
    ).select(
        "s.state_name", *layout.keys, nothing.alias("pos"), "s.map_key", "s.value", "s.found"
    )
    items = elements.select(
        F.lit(LIST_STATE).alias("state_name"),
        *layout.keys,
        F.col("pos").cast("bigint").alias("pos"),
        no_entry.alias("map_key"),
        F.col(n).alias("value"),
        F.lit(True).alias("found"),
    )
    return scalars.unionByName(items)
