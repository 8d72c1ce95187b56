"""Conversations from messages that quote each other.

A message's lines have quote levels (the number of leading `>`).  Runs of lines of one
level are passages; passages and their lines are normalised and hashed.  A quoted hash is
joined to the own text of earlier messages: in the message's own thread to the latest
that has it, else, if it is long enough to mean something, to the first in the corpus.
The lowest quote level with a match gives the parent, there the message with most
matches, then the latest.  Parents make trees; each tree is a conversation, whose messages
come in the order of posting, a reply behind what it answers, without quotes.

A hash that very many messages share makes no pairs: within threads the latest earlier
message is found by a running maximum, in two steps so that a large group spreads over
many tasks, and across threads the first is a minimum per hash.

Defined results: a null text is an empty one; such messages have no quotes and nothing to
be quoted.  Rows without an id are left out.  Rows that repeat an id are one message (the
least by text).  A null thread is a thread of its own.  Equal matches go to the latest
message.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import written

#: Words from which a passage may be looked for outside its thread.
MEANINGFUL_WORDS = 5
#: Messages of a group that are followed by one task, as a power of 2 of their ids.
GROUP_BITS = 16


def level(line: str) -> tuple[int, str]:
    """Number of leading `>`, which blanks may part, and the rest of the line."""
    count, at = 0, 0
    for i, c in enumerate(line):
        if c == ">":
            count, at = count + 1, i + 1
        elif c not in " \t" or not count:
            break
    return count, line[at:].strip() if count else line


def normal(text: str) -> str:
    """Lower case, single blanks, no marks at either end."""
    text = " ".join(text.lower().split())
    return text.strip(" .,;:!?\"'*_-")


def parse(text: str | None) -> tuple[str, list[tuple[int, int, int]]]:
    """Own text, and (level, hash, words) of the passages of every level."""
    lines = [level(x) for x in (text or "").splitlines()]
    announces = re.compile(r"\b(wrote|schrieb|écrit|escribió)\s*:\s*$")
    own, passages, run = [], [], []

    def close():
        if run:
            passages.append((run[0][0], [x for _, x in run]))
            run.clear()

    for i, (depth, rest) in enumerate(lines):
        follows = i + 1 < len(lines) and lines[i + 1][0] > depth
        if follows and announces.search(rest):  # "... wrote:" before a quote
            close()
            continue
        if depth == 0:
            own.append(rest)
        if not rest.strip():
            close()
            continue
        if run and run[0][0] != depth:
            close()
        run.append((depth, rest))
    close()
    units: dict[tuple[int, int], int] = {}
    for depth, parts in passages:
        for unit in {normal(" ".join(parts)), *map(normal, parts)}:
            if unit:
                mark = int.from_bytes(hashlib.blake2b(unit.encode(), digest_size=8).digest(), "little", signed=True)
                units[depth, mark] = len(unit.split())
    return "\n".join(own).strip(), [(d, h, n) for (d, h), n in units.items()]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct({"level": pa.int32(), "hash": pa.int64(), "words": pa.int32()}))
    for batch in batches:
        own, units = [], []
        for text in batch.column("text").to_pylist():
            mine, found = parse(text)
            own.append(mine)
            units.append([{"level": d, "hash": h, "words": n} for d, h, n in found])
        yield pa.record_batch(
            {
                "msg": batch.column("msg"),
                "thread": batch.column("thread"),
                "own": pa.array(own, pa.string()),
                "units": pa.array(units, kind),
            }
        )


def _latest_earlier(quoted: DataFrame, owned: DataFrame) -> DataFrame:
    """For each quoted (hash, thread, msg): `match`, the latest earlier owner, or null."""
    rows = owned.select("hash", "thread", "msg", F.lit(None).cast("int").alias("level"), F.lit(0).alias("words"), F.col("msg").alias("owner"))
    rows = rows.unionByName(quoted.withColumn("owner", F.lit(None).cast("bigint")))
    rows = rows.withColumn("part", F.shiftright("msg", GROUP_BITS))
    keys = ["hash", "thread", "part"]
    ends = rows.filter("owner IS NOT NULL").groupBy(*keys).agg(F.max("owner").alias("last"))
    parts = rows.select(*keys).distinct().join(ends, keys, "left")
    earlier = Window.partitionBy("hash", "thread").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, F.max("last").over(earlier).alias("before"))
    within = Window.partitionBy(*keys).orderBy("msg").rangeBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("near", F.max("owner").over(within)).filter("owner IS NULL")
    return near.join(parts, keys, "left").withColumn("match", F.coalesce("near", "before")).drop("near", "before", "part", "owner")


def parents(parsed: DataFrame) -> DataFrame:
    """(msg, parent) of the messages that quote an earlier one."""
    units = parsed.select("msg", "thread", F.explode("units").alias("u")).select("msg", "thread", "u.*")
    owned = units.filter("level = 0").select("msg", "thread", "hash")
    quoted = units.filter("level > 0")
    inside = _latest_earlier(quoted, owned)
    first = owned.groupBy("hash").agg(F.min("msg").alias("first"))
    outside = inside.filter(F.col("match").isNull() & (F.col("words") >= MEANINGFUL_WORDS))
    outside = outside.join(first, "hash").filter("first < msg").withColumn("match", F.col("first")).drop("first")
    found = inside.filter("match IS NOT NULL").unionByName(outside)
    votes = found.groupBy("msg", "level", "match").agg(F.sum("words").alias("words"))
    best = F.max_by("match", F.struct((-F.col("level")).alias("low"), "words", "match"))
    return votes.groupBy("msg").agg(best.alias("parent"))


def trees(linked: DataFrame) -> DataFrame:
    """(msg, parent, root, depth): every round doubles how far up a message looks.

    Messages that have found their root are joined no more.
    """
    step = linked.select("msg", "parent", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("bigint").alias("depth"))
    step = step.withColumn("top", F.coalesce("parent", "msg"))
    step = written(step, "quotes-trees")
    while True:
        open_rows = step.filter("up IS NOT NULL")
        if open_rows.isEmpty():
            break
        above = step.select(F.col("msg").alias("node"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("top").alias("higher"))
        joined = open_rows.join(above, open_rows["up"] == above["node"], "left")
        looked = joined.select(
            "msg",
            "parent",
            F.col("next").alias("up"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.coalesce("higher", "top").alias("top"),
        )
        step = written(looked.unionByName(step.filter("up IS NULL")), "quotes-trees")
    return step.select("msg", "parent", F.col("top").alias("root"), "depth")


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds position, from 0, in the order of posting within the root."""
    rows = rows.withColumn("part", F.shiftright("msg", GROUP_BITS))
    sizes = rows.groupBy("root", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("root").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("root", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("root", "part").orderBy("msg")) - 1
    return rows.withColumn("within", within).join(sizes, ["root", "part"]).withColumn("position", F.col("before") + F.col("within"))


def conversations(messages: DataFrame) -> DataFrame:
    """(msg, root, parent, depth, position, text) for `messages` (msg, thread, text).

    `msg` is a whole number that grows with the time of posting.
    """
    given = messages.filter("msg IS NOT NULL").groupBy(F.col("msg").cast("bigint").alias("msg")).agg(
        F.min(F.struct("text", F.struct("thread").alias("thread"))).alias("row")
    )
    # Null threads are equal to each other; they may not be lost in a join.
    thread = F.coalesce(F.concat(F.lit("t"), F.col("row.thread.thread").cast("string")), F.lit(""))
    given = given.select("msg", thread.alias("thread"), F.col("row.text").alias("text"))
    parsed = written(
        given.mapInArrow(
            _parsed, "msg bigint, thread string, own string, units array<struct<level:int,hash:bigint,words:int>>"
        ),
        "quotes-parsed",
    )
    linked = parsed.select("msg").join(parents(parsed), "msg", "left")
    placed = _numbered(trees(linked))
    out = placed.join(parsed.select("msg", F.col("own").alias("text")), "msg")
    return out.select("msg", "root", "parent", "depth", "position", "text")
