"""Event sources: files of event lines, multi-line text values, and event arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.common import to_col
from eventloom.functions.lines import split_lines

# The order key of a line read from files: which file, which split of it, and an
# id that increases with the line's position inside that split.
FILE_ORDER = ("file_path", "file_block_start", "line_key")
FILE_SEGMENT = ("file_path", "file_block_start")


def read_event_file(spark: SparkSession, path: str | list[str], value: str = "raw") -> DataFrame:
    """Lines of text files as events, with an order key.

    Returns ``file_path, file_block_start, line_key, <value>``. A line ends at LF,
    CR or CRLF. ``(file_path, file_block_start)`` names the file split (file
    source metadata) and is the natural segment of the two-level running sums.
    ``line_key`` is ``monotonically_increasing_id()``: a split is read by one
    task, front to back, so the id increases with the line's position inside the
    split. Its absolute value depends on how splits are packed into tasks, but
    running sums only compare ids inside one split and add per-split offsets, so
    they are the same however the splits are packed when a job is re-planned or
    a task is recomputed.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
        F.monotonically_increasing_id().alias("line_key"),
        F.col("value").alias(value),
    )


def lines_from_text(df: DataFrame, text: Column | str, out: str = "line", pos: str = "line_no") -> DataFrame:
    """One row per line of a multi-line text value, with its zero-based position (bigint)."""
    exploded = df.select("*", F.posexplode(split_lines(to_col(text))).alias(pos, out))
    return exploded.withColumn(pos, F.col(pos).cast("long"))


def events_from_array(df: DataFrame, arr: Column | str, out: str = "raw", pos: str = "pos") -> DataFrame:
    """One row per element of an ``array<string>`` of events, with its position (bigint)."""
    exploded = df.select("*", F.posexplode(to_col(arr)).alias(pos, out))
    return exploded.withColumn(pos, F.col(pos).cast("long"))
