"""Parquet tables, in batch and as streams, and the token stream over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.tokens import CLEAR_TOKEN

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stream_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table, one file or a folder of them, as a stream; a batch is all that has arrived."""
    schema = read_table(spark, folder, table).schema
    # A pattern, since a stream takes a plain path for a folder.
    return spark.readStream.schema(schema).parquet(f"{folder}/{table}.parque[t]")


def stream_events(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    """The events table, one file or a folder of them, as a stream.

    Without `files_per_batch` a batch is all that has arrived.
    """
    reader = spark.readStream.schema(EVENTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A pattern, since a stream takes a plain path for a folder.
    return reader.parquet(f"{folder}/events.parque[t]")


def event_tokens(events: DataFrame) -> DataFrame:
    """Events as tokens: (key, seq, tok).

    An error clears, a view gives a token that is no number, and any other
    event gives the number in its properties.
    """
    kind = F.col("event_type")
    token = (
        F.when(kind == "error", CLEAR_TOKEN)
        .when(kind == "view", F.concat(F.lit("x"), F.col("event_id").cast("string")))
        .otherwise(F.col("k"))
    )
    return with_property(events).select(
        F.col("user_id").alias("key"), F.col("event_id").alias("seq"), token.alias("tok")
    )


def with_property(events: DataFrame) -> DataFrame:
    """Events with the number in their properties as text in `k`.

    As a generator the JSON is parsed once per row; a plain expression would be
    parsed again in every filter that Spark pushes below it.
    """
    return events.select("event_id", "user_id", "event_type", F.json_tuple("props", "k").alias("k"))
