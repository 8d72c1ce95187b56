"""Named state of a stream, read from its checkpoint as DataFrames.

Values are those of the last committed batch, or of `batch` where given.  The
stream may be running or stopped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keyed import (
    KEYED_STATE,
    LIST_STATE,
    MAP_STATE,
    REDUCING_STATE,
    VALUE_STATE,
)
from tidemark.plans.layout import names

# The published names, and the state variable each is kept in.
VARIABLES = {
    VALUE_STATE: "value_query",
    LIST_STATE: "list_query",
    MAP_STATE: "map_query",
    REDUCING_STATE: "reduce_query",
    KEYED_STATE: "keyed_query",
}


def state_names(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Names and kinds of the states kept under a checkpoint: (name, kind)."""
    stored = spark.read.format("state-metadata").load(checkpoint)
    variables = F.from_json(
        F.get_json_object("operatorProperties", "$.stateVariables"),
        "array<struct<stateName string, stateVariableType string>>",
    )
    return (
        stored.select(F.explode(variables).alias("v"))
        .filter(~F.col("v.stateName").startswith("$"))
        .select(F.col("v.stateName").alias("name"), F.col("v.stateVariableType").alias("kind"))
    )


def read_state(
    spark: SparkSession, checkpoint: str, name: str | None = None, batch: int | None = None
) -> DataFrame:
    """One state as stored; without a name, the state of a built-in aggregate."""
    reader = spark.read.format("statestore").option("path", checkpoint)
    if name:
        reader = reader.option("stateVarName", name)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load()


def changes(
    spark: SparkSession,
    checkpoint: str,
    state: str,
    first: int = 0,
    last: int | None = None,
) -> DataFrame:
    """What batches `first` to `last` did to a published state: (batch, keys, ..., change).

    One row per key, or entry of a key, and change; `change` is `update` or `delete`.
    Several changes of one key in one batch leave several rows, in no order: a clear
    and what follows it.  Between key and change stand the columns of the state's reader,
    null where it was deleted; list elements come by segment (start, items).
    """
    reader = spark.read.format("statestore").option("path", checkpoint)
    reader = reader.option("stateVarName", VARIABLES[state]).option("readChangeFeed", True)
    reader = reader.option("changeStartBatchId", first)
    if last is not None:
        reader = reader.option("changeEndBatchId", last)
    feed = reader.load()
    columns = {
        VALUE_STATE: [F.col("value.n").alias("value"), F.col("value.size").alias("size")],
        REDUCING_STATE: [F.col("value.n").alias("value")],
        KEYED_STATE: [F.col("value.n").alias("value")],
    }
    if state == MAP_STATE:
        own = [F.col("user_map_key.map_key").alias("map_key"), F.col("user_map_value.n").alias("value")]
    elif state == LIST_STATE:
        own = [F.col("user_map_key.start").alias("start"), F.col("user_map_value.items").alias("items")]
    else:
        own = columns[state]
    change = F.when(F.col("change_type") == "delete", "delete").otherwise("update")
    return feed.select(F.col("batch_id").alias("batch"), *_keys(feed), *own, change.alias("change"))


def saved_sums(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """All that a stream of sums keeps, for a new one to start from.

    (keys, sums, latest, segments): a row for each key with its `sums` (n, size, at_...),
    and one for each segment (start, items) of its list.  They stand in arrays of one
    element at most, so that no null turns whole numbers into floats on their way.
    """
    kept = {row["name"] for row in state_names(spark, checkpoint).collect()}
    value = read_state(spark, checkpoint, "value_query", batch)
    keys = [c for c in value.schema["key"].dataType.names]
    sums = value.select(*_keys(value), "value.*")
    latest = read_state(spark, checkpoint, "keyed_query", batch)
    latest = latest.select(*_keys(latest), F.col("value.n").alias("latest"))
    same = reduce(Column.__and__, [sums[k].eqNullSafe(latest[k]) for k in keys])
    fields = [sums[c] for c in sums.columns if c not in keys]
    some = F.array_compact(F.array(F.col("latest")))
    out = sums.join(latest, same, "left").select(
        *[sums[k] for k in keys],
        F.array(F.struct(*fields)).alias("sums"),
        some.alias("latest"),
        F.array().cast("array<struct<start bigint, items array<bigint>>>").alias("segments"),
    )
    if "list_query" not in kept:
        return out
    parts = read_state(spark, checkpoint, "list_query", batch)
    segment = F.struct("user_map_key.start", "user_map_value.items")
    none = {name: F.array().cast(out.schema[name].dataType).alias(name) for name in ("sums", "latest")}
    return out.unionByName(parts.select(*_keys(parts), *none.values(), F.array(segment).alias("segments")))


def _keys(state: DataFrame) -> list[Column]:
    return [F.col(f"key.{field}") for field in state.schema["key"].dataType.names]


def value_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Current sums; 0 right after a clear: (keys, value)."""
    state = read_state(spark, checkpoint, "value_query", batch)
    return state.select(*_keys(state), F.col("value.n").alias("value"))


def list_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """List elements, one row each: (keys, pos, n)."""
    state = read_state(spark, checkpoint, "list_query", batch)
    start = F.col("user_map_key.start").alias("start")
    parts = state.select(*_keys(state), start, F.posexplode("user_map_value.items"))
    keys = [c for c in parts.columns if c not in ("start", "pos", "col")]
    return parts.select(*keys, (F.col("start") + F.col("pos")).alias("pos"), F.col("col").alias("n"))


def map_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Map entries: (keys, map_key, value)."""
    state = read_state(spark, checkpoint, "map_query", batch)
    return state.select(
        *_keys(state), "user_map_key.map_key", F.col("user_map_value.n").alias("value")
    )


def reducing_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Sums since the last clear; no row where there is none: (keys, value)."""
    state = read_state(spark, checkpoint, "reduce_query", batch)
    return state.select(*_keys(state), F.col("value.n").alias("value"))


def keyed_latest(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Last emitted sums: (keys, value)."""
    state = read_state(spark, checkpoint, "keyed_query", batch)
    return state.select(*_keys(state), F.col("value.n").alias("value"))


def vocabulary(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Word lists: (keys, pos, word, count)."""
    state = read_state(spark, checkpoint, "wc", batch)
    return state.select(
        *_keys(state), "user_map_value.pos", "user_map_key.word", "user_map_value.count"
    )


READERS = {
    VALUE_STATE: value_state,
    LIST_STATE: list_state,
    MAP_STATE: map_state,
    REDUCING_STATE: reducing_state,
    KEYED_STATE: keyed_latest,
}


def normalised(key: object) -> object:
    """A key as the interactive clients send it: in lower case, without outer blanks."""
    return key.lower().strip() if isinstance(key, str) else key


def normalised_column(column: str) -> Column:
    """A text column as `normalised` makes a key."""
    return F.regexp_replace(F.lower(column), r"(?U)^\s+|\s+\z", "")


def lookup(
    spark: SparkSession,
    checkpoint: str,
    key: object,
    states: str | Sequence[str] = tuple(VARIABLES),
    normalise: bool = False,
    batch: int | None = None,
) -> DataFrame:
    """States of one key: (state_name, pos, map_key, value, found).

    `key` is a value, or a tuple for several key columns.  A state that the key
    does not hold, or that the checkpoint does not keep, gives one row with
    found = false and does not affect the others.
    """
    parts = key if isinstance(key, tuple) else (key,)
    if normalise:
        parts = tuple(normalised(part) for part in parts)
    asked = names(states)
    # Only what the checkpoint does not keep counts as absent; any error is raised.
    kept = {row["name"] for row in state_names(spark, checkpoint).collect()}
    if not kept:
        raise ValueError(f"no states are kept under {checkpoint}")
    found = [_of_key(spark, checkpoint, name, parts, batch) for name in asked if VARIABLES[name] in kept]
    wanted = spark.createDataFrame([(name,) for name in asked], "state_name string")
    if not found:
        none = F.lit(None)
        return wanted.select(
            "state_name",
            none.cast("bigint").alias("pos"),
            none.cast("string").alias("map_key"),
            none.cast("bigint").alias("value"),
            F.lit(False).alias("found"),
        )
    rows = reduce(DataFrame.unionByName, found)
    return wanted.join(rows, "state_name", "left").withColumn("found", F.col("value").isNotNull())


def _of_key(spark, checkpoint, name, parts, batch):
    rows = _elements(spark, checkpoint, name, batch)
    keys = [c for c in rows.columns if c not in ("state_name", "pos", "map_key", "value")]
    match = reduce(Column.__and__, [F.col(c) == F.lit(p) for c, p in zip(keys, parts, strict=True)])
    return rows.filter(match).select("state_name", "pos", "map_key", "value")


def lookup_many(
    keys: DataFrame,
    checkpoint: str,
    states: str | Sequence[str] = tuple(VARIABLES),
    normalise: bool = False,
    batch: int | None = None,
) -> DataFrame:
    """States of all keys of a table: (state_name, keys, pos, map_key, value, found).

    One read of each state, joined with the distinct keys, whose columns are named and
    typed as those of the state.  What a key does not hold is one row with found = false.
    With `normalise`, text keys are taken, and returned, in lower case without outer blanks.
    """
    if normalise:
        texts = [name for name, kind in keys.dtypes if kind == "string"]
        keys = keys.withColumns({name: normalised_column(name) for name in texts})
    spark, asked = keys.sparkSession, names(states)
    kept = {row["name"] for row in state_names(spark, checkpoint).collect()}
    if not kept:
        raise ValueError(f"no states are kept under {checkpoint}")
    columns = keys.columns
    wanted = keys.distinct().select(
        *columns, F.explode(F.array(*[F.lit(name) for name in asked])).alias("state_name")
    )
    held = [_elements(spark, checkpoint, name, batch) for name in asked if VARIABLES[name] in kept]
    if held:
        found = wanted.join(reduce(DataFrame.unionByName, held), ["state_name", *columns], "left")
    else:
        nothing = {"pos": "bigint", "map_key": "string", "value": "bigint"}
        found = wanted.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()})
    return found.select(
        "state_name", *columns, "pos", "map_key", "value", F.col("value").isNotNull().alias("found")
    )


def _elements(spark, checkpoint, name, batch):
    """A state as (state_name, keys, pos, map_key, value)."""
    rows = READERS[name](spark, checkpoint, batch)
    keys = [c for c in rows.columns if c not in ("pos", "map_key", "value", "n")]
    return rows.select(
        F.lit(name).alias("state_name"),
        *keys,
        F.col("pos") if "pos" in rows.columns else F.lit(None).cast("bigint").alias("pos"),
        F.col("map_key") if "map_key" in rows.columns else F.lit(None).cast("string").alias("map_key"),
        F.col("n" if "n" in rows.columns else "value").alias("value"),
    )


def lookup_aggregate(
    spark: SparkSession,
    checkpoint: str,
    key: object,
    normalise: bool = False,
    batch: int | None = None,
) -> DataFrame:
    """One key of a built-in aggregate, such as a word count: (value, found).

    Words are counted as they come, so with `normalise` a word with capitals is
    not found.
    """
    key = normalised(key) if normalise else key
    state = read_state(spark, checkpoint, batch=batch)
    [name], [value] = state.schema["key"].dataType.names, state.schema["value"].dataType.names
    rows = state.filter(F.col(f"key.{name}") == F.lit(key))
    # An aggregate without groups gives one row, also where there is no such key.
    return rows.agg(
        F.first(f"value.{value}").alias("value"), (F.count("*") > 0).alias("found")
    )


def snapshot(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """All five states of every key: (state_name, keys, pos, map_key, value, found)."""
    state = read_state(spark, checkpoint, "value_query", batch)
    sums = state.select(*_keys(state), F.col("value.n").alias("n"), F.col("value.size").alias("size"))
    keys = [c for c in sums.columns if c not in ("n", "size")]
    nothing = F.lit(None).cast("bigint")
    no_entry = F.lit(None).cast("string")

    def rows(name, df, pos=nothing, map_key=no_entry, value=nothing):
        return df.select(
            F.lit(name).alias("state_name"),
            *keys,
            pos.alias("pos"),
            map_key.alias("map_key"),
            value.alias("value"),
            value.isNotNull().alias("found"),
        )

    # A key without numbers since its last clear has none of these three.
    bare = sums.filter(F.col("size") == 0)
    latest = keyed_latest(spark, checkpoint, batch).withColumnsRenamed({k: f"__{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    value = F.col("value")
    parts = [
        rows(VALUE_STATE, sums, value=F.col("n")),
        *[rows(name, bare) for name in (LIST_STATE, MAP_STATE, REDUCING_STATE)],
        rows(LIST_STATE, list_state(spark, checkpoint, batch), pos=F.col("pos"), value=F.col("n")),
        rows(
            MAP_STATE,
            map_state(spark, checkpoint, batch),
            map_key=F.col("map_key"),
            value=value,
        ),
        rows(REDUCING_STATE, reducing_state(spark, checkpoint, batch), value=value),
        rows(KEYED_STATE, sums.select(*keys).join(latest, same, "left"), value=value),
    ]
    return reduce(DataFrame.unionByName, parts)
