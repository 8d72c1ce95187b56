"""Conversations as mails that quote the turns before them, for `quotes`.

All turns are dealt out in the order of (conv_id, turn), so a long conversation lies in
many tasks.  A task goes through its turns once and holds the last two that can be
quoted.  What the first turns of a task quote lies in tasks before it: those turns are
left open, and are joined with the last two turns of the nearest task that has some.
Per task one row without texts reaches the driver.

A message's id is its place in that order, whatever the numbers of its turn and
conversation are.

Defined results: every row is a message, also with a null conv_id (one conversation), a
null turn (the last ones) or a repeated turn (in the order of a hash of the text).  A
turn whose text has nothing that could be quoted, such as a null, is passed over: the
next turn quotes the ones before it.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import quotes
from tidemark.llm.store import written

PLACED = "msg bigint, conv_id bigint, turn bigint, text string, older string, last string, said bigint, blank boolean, lacks int, tail int"
KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
#: Bits for a message's place in its task.
PLACE_BITS = 33


def quotable(text: str | None) -> bool:
    """If a message with this text says something that `quotes` finds in others."""
    if not text:
        return False
    depth, rest = quotes.level(text.partition("\n")[0])
    if depth == 0 and quotes.normal(rest) and not rest.rstrip().endswith(":"):
        return True
    return any(depth == 0 for depth, _, _ in quotes.parse(text)[1])


def quoted(text: str, mark: str) -> str:
    return "\n".join(mark + line for line in text.splitlines())


def mail(text: str | None, last: str | None, said: int | None, older: str | None) -> str | None:
    if last is None:
        return text
    parts = [quoted(older, ">> ")] if older is not None else []
    turn = "" if said is None else said
    return f"On turn {turn} someone wrote:\n" + "\n".join([*parts, quoted(last, "> ")]) + "\n\n" + (text or "")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mails in order; behind them, as tails, the last two turns that can be quoted.

    `lacks` says how many of those that a turn quotes may lie in earlier tasks; such a turn
    has its own text and what is known of the others.
    """
    part, at = TaskContext.get().partitionId(), 0
    held: list[tuple[int | None, str]] = []
    conv, first, any_row = None, True, False
    names = [c.split()[0] for c in PLACED.split(", ")]
    kinds = [KINDS[c.split()[1]] for c in PLACED.split(", ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "text"))
        for key, turn, text in zip(*columns, strict=True):
            if any_row and key != conv:
                held, first = [], False
            conv, any_row = key, True
            said, last = held[-1] if held else (None, None)
            older = held[-2][1] if len(held) > 1 else None
            msg, lacks = (part << PLACE_BITS) + at, 2 - len(held) if first else 0
            if lacks:
                rows.append((msg, key, turn, text, older, last, said, text is None, lacks, 0))
            else:
                rows.append((msg, key, turn, mail(text, last, said, older), None, None, None, text is None, 0, 0))
            at += 1
            if quotable(text):
                held = [*held[-1:], (turn, text)]
        if rows:
            yield made(rows)
    if any_row:
        # The last is tail 1; a task of one conversation lets earlier ones be seen: lacks.
        lacks = 2 - len(held) if first else 0
        tails = [(part << PLACE_BITS, conv, t, x, None, None, None, False, lacks, i) for i, (t, x) in enumerate(reversed(held), 1)]
        yield made(tails or [(part << PLACE_BITS, conv, None, None, None, None, None, True, lacks, 3)])


def _mails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("text", "last", "said", "older"))
        text = [mail(*row) for row in zip(*columns, strict=True)]
        yield pa.record_batch({"msg": batch.column("msg"), "thread": batch.column("thread"), "text": pa.array(text, pa.string())})


def sources(tails: list[tuple[int, int | None, int, int]]) -> list[tuple[int, int | None, int, int, int]]:
    """(part, conv_id, rank, from_part, from_tail): the last two turns before each part.

    `tails` has (part, conv_id, how many tails, lacks) in the order of parts.
    """
    out, conv, held = [], None, []
    for part, key, count, lacks in tails:
        out += [(part, conv, rank, *place) for rank, place in enumerate(held, 1)]
        own = [(part, i) for i in range(1, count + 1)]
        held = (own + held)[:2] if lacks and key == conv else own
        conv = key
    return out


def quoting(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages (msg, thread, text) for `turns` (conv_id, turn, text), and (msg, conv_id, turn, blank)."""
    spark = turns.sparkSession
    given = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "text")
    given = given.withColumn("mark", F.xxhash64("text"))
    order = [F.asc("conv_id"), F.asc_nulls_last("turn"), F.asc("mark")]
    dealt = given.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(dealt.select("conv_id", "turn", "text").mapInArrow(_placed, PLACED), "mails-placed")
    tail = placed.filter("tail > 0").withColumn("part", F.shiftright("msg", PLACE_BITS))
    ends = tail.groupBy("part").agg(
        F.first("conv_id").alias("conv_id"), F.sum(F.expr("int(tail < 3)")).alias("count"), F.first("lacks").alias("lacks")
    )
    found = sources(sorted(tuple(r) for r in ends.collect()))
    found = spark.createDataFrame(found, "to_part bigint, to_conv bigint, rank int, from_part bigint, from_tail int")
    same = (F.col("part") == F.col("from_part")) & (F.col("tail") == F.col("from_tail"))
    carried = tail.select("part", "tail", "turn", "text").join(found, same).groupBy("to_part", "to_conv").agg(
        *[F.max(F.when(F.col("rank") == k, F.struct("turn", "text"))).alias(f"c{k}") for k in (1, 2)]
    )
    rows = placed.filter("tail = 0")
    left = rows.filter("lacks > 0").withColumn("part", F.shiftright("msg", PLACE_BITS))
    left = left.join(carried, (F.col("part") == F.col("to_part")) & F.col("conv_id").eqNullSafe(F.col("to_conv")), "left")
    none = F.col("lacks") == 2
    left = left.select(
        "msg",
        F.col("conv_id").alias("thread"),
        "text",
        F.when(none, F.col("c2.text")).otherwise(F.col("c1.text")).alias("older"),
        F.when(none, F.col("c1.text")).otherwise(F.col("last")).alias("last"),
        F.when(none, F.col("c1.turn")).otherwise(F.col("said")).alias("said"),
    )
    made = left.mapInArrow(_mails, "msg bigint, thread bigint, text string")
    whole = rows.filter("lacks = 0").select("msg", F.col("conv_id").alias("thread"), "text")
    return whole.unionByName(made), rows.select("msg", "conv_id", "turn", "blank")


def labelled(found: DataFrame, names: DataFrame) -> DataFrame:
    """The result of `quotes.conversations` with the numbers of turns in place of ids."""
    above = names.select(F.col("msg").alias("parent"), F.col("turn").alias("parent_turn"))
    top = names.select(F.col("msg").alias("root"), F.col("conv_id").alias("root_conv_id"))
    # A root that very many messages have is met once for each group of them.
    group = F.shiftright("msg", quotes.GROUP_BITS).alias("group")
    tops = found.select("root", group).distinct().join(top, "root")
    out = found.join(names, "msg").join(above, "parent", "left").withColumn("group", group)
    out = out.join(tops, ["root", "group"])
    text = F.when(~F.col("blank"), F.col("text")).alias("text")
    return out.select("conv_id", "turn", "root_conv_id", "parent_turn", "depth", "position", text)
