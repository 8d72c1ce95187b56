"""Text files and text streams as lines, with their order where it is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of one or more text files, unordered: (value).

    A line ends at `\\n` only; a carriage return stays and counts as a blank.
    """
    return spark.read.option("lineSep", "\n").text(path)


# Order columns of the lines of a file, and of the tokens in them.
LINE_ORDER = ("start", "arrival")
TOKEN_ORDER = (*LINE_ORDER, "pos")


def read_ordered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their order in their file: (file, start, arrival, value).

    Large files stay split and nothing is shuffled: splits are ordered by the
    byte at which they start, and rows come out of a split in file order.  The
    numbers in `arrival` hold within one query only.
    """
    return read_lines(spark, path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("arrival"),
        "value",
    )


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files dropped in a folder as a stream of lines: (value)."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def stream_ordered_lines(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """As `stream_lines`, with the order: (modified, file, line, value).

    A stream cannot number rows, so each file is read whole and must fit in a
    task; drop many files of moderate size.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.text(path, wholetext=True).select(
        F.unix_micros("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_path").alias("file"),
        # A final line end starts no further line.
        F.split(F.regexp_replace("value", r"\n\z", ""), "\n").alias("lines"),
    )
    return files.select("modified", "file", F.posexplode("lines").alias("line", "value"))
