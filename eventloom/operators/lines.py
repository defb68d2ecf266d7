"""Normalising event text for the wire: one LF per line, CR and CRLF folded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.common import to_col
from eventloom.functions.lines import LF, split_lines


def normalize_lines(df: DataFrame, text: Column | str, out: str = "line", pos: str = "line_no") -> DataFrame:
    """One row per wire line: each line of ``text`` followed by exactly one LF.

    A value holding line breaks therefore becomes several lines on the wire.
    """
    exploded = df.select("*", F.posexplode(split_lines(to_col(text))).alias(pos, "_l"))
    return exploded.withColumn(pos, F.col(pos).cast("long")).withColumn(
        out, F.concat(F.col("_l"), F.lit(LF))).drop("_l")
