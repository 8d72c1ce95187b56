"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import scratch_folder


def written(df: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """`df`, computed once: later reads need neither its inputs nor its executors."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
