"""Running sums per key in order, restarted at marked rows, for any skew.

Light keys: one exchange on the key, then sorts and window functions.

Heavy keys: one exchange on (key, chunk), so the rows of a key lie in many
tasks.  Each chunk is scanned alone; the last values of the chunks form a small
table, which is scanned the same way per key and gives every chunk what its
predecessors leave over.  That carry counts only for rows before the first
restart in the chunk.  It is joined on (key, chunk), never on the key alone, so
no step meets all rows of a heavy key in one task.

In both cases the exchange carries the columns as given and what is derived
from them is computed behind it.  So fewer bytes move, and the rows and the
carry of the heavy keys read one and the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.layout import Layout

LOW_HALF = (1 << 32) - 1
KEY = "__key"
CHUNK = "__chunk"


@dataclass(frozen=True)
class Pass:
    """One way through the rows of each key.

    sums: new column -> integral value, added up since, and with, the last
      restart row; make it 0 on restart rows to leave them out.
    previous: new column -> value, taken from the row before, restarts or not;
      null on the first row.
    restart: true on rows where the sums start again; none means never.
    seen: new column, true from the first restart row of the key on.
    descending: go through the order from its end.
    """

    sums: Mapping[str, Column] = field(default_factory=dict)
    restart: Column | None = None
    seen: str | None = None
    descending: bool = False
    previous: Mapping[str, Column] = field(default_factory=dict)


Scan = Callable[..., DataFrame]


def ordered_scan(df: DataFrame, layout: Layout, *passes: Pass, placed: bool = False) -> DataFrame:
    """`df` with the columns of independent passes.

    placed: the rows of a light key are together already.
    """
    return in_order(df, layout, lambda rows, scan: scan(rows, *passes), placed)


def in_order(
    df: DataFrame,
    layout: Layout,
    steps: Callable[[DataFrame, Scan], DataFrame],
    placed: bool = False,
) -> DataFrame:
    """Run `steps`, one or more scans that build on each other, behind one exchange.

    `steps(rows, scan)` may filter rows and add columns between its scans, and
    calls `scan(rows, *passes)`.  Every further scan of heavy keys repeats the
    windows, not the exchange, of those before it; so put independent passes
    into one scan.
    """
    if not layout.heavy:
        return steps(df if placed else _placed(df, layout.keys), _whole_groups(layout))
    heavy = layout.is_heavy()
    light = steps(_placed(df.filter(~heavy), layout.keys), _whole_groups(layout))
    # A struct is never null, and equal to another also where fields of both
    # are null, so null keys find their carry too.
    split = (
        df.filter(heavy)
        .withColumn(KEY, F.struct(F.lit(0), *layout.keys))
        .withColumn(CHUNK, layout.chunk())
        .drop(*layout.keys)
    )
    split = _placed(split, [KEY, CHUNK] if layout.keys else [CHUNK])
    split = split.withColumns({k: F.col(f"{KEY}.{k}") for k in layout.keys})
    split = steps(split, _split_groups(layout)).drop(KEY, CHUNK)
    return light.unionByName(split) if layout.keys else split.select(light.columns)


def _placed(df, columns):
    return df.repartition(*columns) if columns else df


def _whole_groups(layout):
    def scan(df, *passes):
        df = _local(df, list(layout.keys), layout.order, passes)
        return _finish(df, passes)

    return scan


def _split_groups(layout):
    group = [KEY] if layout.keys else []

    def scan(df, *passes):
        local = _local(df, [*group, CHUNK], layout.order, passes)
        rows = local.join(_carry(local, group, layout, passes), [*group, CHUNK])
        for i, p in enumerate(passes):
            first = F.col(_epoch(i)) == 0
            added = {
                s: F.col(s) + F.when(first, F.col(_carried(s))).otherwise(0) for s in p.sums
            }
            for name in p.previous:
                opening = F.col(_opens(i))
                added[name] = F.when(opening, F.col(_carried(name))).otherwise(F.col(name))
            added[_epoch(i)] = F.col(_epoch(i)) + F.col(_carried(_epoch(i)))
            rows = rows.withColumns(added).drop(*[_carried(c) for c in added])
        return _finish(rows, passes)

    return scan


def _epoch(i):
    return f"__epoch{i}"


def _opens(i):
    return f"__opens{i}"


def _carried(name):
    return f"__carried_{name}"


def _finish(rows, passes):
    for i, p in enumerate(passes):
        if p.seen:
            rows = rows.withColumn(p.seen, F.col(_epoch(i)) > 0)
        rows = rows.drop(_epoch(i), _opens(i))
    return rows


def _ordered(group, columns, descending):
    order = [F.desc(c) if descending else F.asc(c) for c in columns]
    return Window.partitionBy(*group).orderBy(*order)


def _local(df, group, order, passes):
    """All passes within each group; adds the restarts so far of each as an epoch."""
    for i, p in enumerate(passes):
        window = _ordered(group, order, p.descending)
        added = {_epoch(i): _restarts(p.restart, window)}
        added |= {name: F.lag(v).over(window) for name, v in p.previous.items()}
        if p.previous:
            added[_opens(i)] = F.row_number().over(window) == 1
        df = _sums_since(df.withColumns(added), p.sums, p.restart, window)
    return df


def _sums_since(df, sums, restart, window):
    """Adds running sums since, and with, the last restart row.

    A sum is the difference of two running totals, so that one sort serves all
    of them; windows per segment would need another.  The totals must not
    overflow where the difference does not: wide values are added up as two
    halves of 32 bits, which stay exact over 2**31 rows of a group.
    """
    so_far = _so_far(window)
    values = {name: F.coalesce(v, F.lit(0)) for name, v in sums.items()}
    if restart is None:
        return df.withColumns({n: F.sum(v.cast("bigint")).over(so_far) for n, v in values.items()})
    kinds = dict(df.select(*[v.alias(n) for n, v in values.items()]).dtypes)
    wide = [n for n in values if kinds[n] == "bigint"]
    parts = {n: v.cast("bigint") for n, v in values.items() if n not in wide}
    for n in wide:
        parts[f"__high_{n}"] = F.shiftright(values[n], 32)
        parts[f"__low_{n}"] = values[n].bitwiseAND(F.lit(LOW_HALF))
    df = df.withColumns({f"__all_{p}": F.sum(v).over(so_far) for p, v in parts.items()})
    df = df.withColumns(
        {
            f"__old_{p}": F.last(F.when(restart, F.col(f"__all_{p}") - v), ignorenulls=True).over(
                so_far
            )
            for p, v in parts.items()
        }
    )

    def since(part):
        return F.col(f"__all_{part}") - F.coalesce(f"__old_{part}", F.lit(0))

    def joined(name):
        low = since(f"__low_{name}")
        high = since(f"__high_{name}") + F.shiftright(low, 32)
        return high * F.lit(LOW_HALF + 1) + low.bitwiseAND(F.lit(LOW_HALF))

    df = df.withColumns({n: joined(n) if n in wide else since(n) for n in values})
    return df.drop(*[f"{side}_{p}" for p in parts for side in ("__all", "__old")])


def _restarts(restart, window):
    if restart is None:
        return F.lit(0).cast("bigint")
    return F.sum(F.when(restart, F.lit(1)).otherwise(0).cast("bigint")).over(_so_far(window))


def _so_far(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _carry(local, group, layout, passes):
    """One row per key and chunk with what the earlier chunks of the key leave over."""
    position = layout.position()
    ends = [F.count("*").alias("__rows")]
    for i, p in enumerate(passes):
        last = F.min_by if p.descending else F.max_by
        ends.append(F.max(_epoch(i)).alias(_epoch(i)))
        ends += [last(s, position).alias(s) for s in p.sums]
        ends += [last(v, position).alias(name) for name, v in p.previous.items()]
    table = local.groupBy(*group, CHUNK).agg(*ends)
    carried = []
    for i, p in enumerate(passes):
        window = _ordered(group, [CHUNK], p.descending)
        epoch = f"__chunks{i}"
        table = table.withColumn(epoch, _restarts(F.col(_epoch(i)) > 0, window))
        ends = {name: F.col(name) for name in p.sums}
        table = _sums_since(table, ends, F.col(_epoch(i)) > 0, window)
        before = {_epoch(i): epoch} | {s: s for s in p.sums}
        carried += [F.lag(c, 1, 0).over(window).alias(_carried(n)) for n, c in before.items()]
        carried += [F.lag(c).over(window).alias(_carried(c)) for c in p.previous]
    return table.select(*group, CHUNK, *carried)
