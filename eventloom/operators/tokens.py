"""A skip index over shipped event files: which files can hold a token, in which time range.

For every file the index has the first and last event time, whether lines without a stamp exist, and
a Bloom filter of the tokens (runs of ASCII letters, digits and ``_``, in lower case). The filter is a
table of its 64-bit words, so that it is built by a grouped ``bit_or`` and a search reads only the words
of its tokens. Its size follows the file's number of distinct tokens. A file that the filter
lets through without need is read for nothing; none that holds the tokens is left out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.extract import event_time_text
from eventloom.functions.timefmt import parse_event_timestamp
from eventloom.operators.search import session_zone, time_bounds, time_range

#: Bits of a filter for each distinct token, and bits set by a token: about 1 % of files pass without need.
BITS_PER_TOKEN, HASHES = 10, 6
TOKEN = "[a-z0-9_]+"
#: Files that a search names one by one; more are told apart by a join on the file's path.
NAMED_FILES = 10_000


def line_tokens(raw: Column | str) -> Column:
    """The distinct tokens of a line."""
    c = raw if isinstance(raw, Column) else F.col(raw)
    return F.array_distinct(F.regexp_extract_all(F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(TOKEN), 0))


def _bits(token: Column, words: Column) -> Column:
    """The bits of a token: an array of (word, bit)."""
    return F.array(*[F.struct(F.pmod(F.xxhash64(token, F.lit(k)), words).cast("int").alias("word"),
                              F.pmod(F.xxhash64(F.lit(k), token), F.lit(64)).cast("int").alias("bit")) for k in range(HASHES)])


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("raw"))


def build_token_index(spark: SparkSession, path: str | list[str], index: str, delim: str = "|", compat: bool = False) -> None:
    """Index the event files of ``path`` into the folder ``index`` (replacing what is there)."""
    lines = _lines(spark, path)
    tokens = lines.select("file_path", F.explode(line_tokens("raw")).alias("token")).distinct()
    tokens.write.mode("overwrite").parquet(f"{index}/tokens")
    tokens = spark.read.parquet(f"{index}/tokens")
    # a power of two, so that files of about one size share their words' numbers
    words = F.greatest(F.lit(1), F.pow(F.lit(2), F.ceil(F.log2(F.coalesce("n_tokens", F.lit(1)) * BITS_PER_TOKEN / 64)))).cast("long")
    time = parse_event_timestamp(event_time_text("raw", delim), compat)
    files = lines.select("file_path", time.alias("t")).groupBy("file_path").agg(
        F.min("t").alias("first_time"), F.max("t").alias("last_time"), F.count_if(F.col("t").isNull()).alias("unstamped"), F.count("*").alias("n_lines"))
    files.join(tokens.groupBy("file_path").agg(F.count("*").alias("n_tokens")), "file_path", "left").withColumn("words", words) \
        .write.mode("overwrite").parquet(f"{index}/files")
    sized = tokens.join(spark.read.parquet(f"{index}/files").select("file_path", "words"), "file_path")
    bits = sized.select("file_path", F.explode(_bits(F.col("token"), F.col("words"))).alias("b")).select("file_path", "b.*")
    filters = bits.groupBy("file_path", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    filters.repartitionByRange(F.col("word")).sortWithinPartitions("word").write.mode("overwrite").parquet(f"{index}/filters")


def candidate_files(spark: SparkSession, index: str, tokens: Sequence[str], earliest: dt.datetime | None = None,
                    latest: dt.datetime | None = None) -> DataFrame:
    """(file_path) of the indexed files that may have a line with all ``tokens`` in the window."""
    files = spark.read.parquet(f"{index}/files")
    if earliest:
        files = files.where(F.col("last_time") >= F.lit(earliest.isoformat()).cast(files.schema["last_time"].dataType))
    if latest:
        files = files.where(F.col("first_time") < F.lit(latest.isoformat()).cast(files.schema["first_time"].dataType))
    filters = spark.read.parquet(f"{index}/filters")
    for token in dict.fromkeys(tokens):
        asked = files.select("file_path", F.explode(_bits(F.lit(token), F.col("words"))).alias("b")).select("file_path", "b.*").distinct()
        # few sizes of filters: few words to read for a token
        sizes = [r[0] for r in files.select("words").distinct().collect()]
        numbers = spark.range(1).select(F.explode(F.array(*[F.lit(s).cast("long") for s in sizes] or [F.lit(1).cast("long")])).alias("w")).select(
            F.explode(_bits(F.lit(token), F.col("w"))).alias("b")).select("b.word").distinct().collect()
        there = filters.where(F.col("word").isin([r[0] for r in numbers])).join(asked, ["file_path", "word"])
        passed = there.where(F.expr("bits & shiftleft(1L, bit)") != 0).groupBy("file_path").agg(F.count("*").alias("n"))
        wanted = asked.groupBy("file_path").agg(F.count("*").alias("wanted"))
        files = files.join(passed.join(wanted, "file_path").where("n = wanted").select("file_path"), "file_path", "left_semi")
    return files.select("file_path")


def search_tokens(spark: SparkSession, path: str | list[str], tokens: Sequence[str], index: str | None = None,
                  earliest: str | dt.datetime | None = None, latest: str | dt.datetime | None = None,
                  now: dt.datetime | str | None = None, delim: str = "|", compat: bool = False) -> DataFrame:
    """(file_path, _time, raw) of the lines that have all ``tokens`` (whole ones, in lower case) in the time window.

    With ``index`` only the files that may have such lines are read; the rows are the same, as long as the index
    was built from the files of ``path``.
    """
    tokens = [t.lower() for t in tokens]
    lines = spark.read.text(path)
    if index is not None:
        files = candidate_files(spark, index, tokens, *time_bounds(earliest, latest, now, session_zone(lines)))
        named = [r[0] for r in files.limit(NAMED_FILES + 1).collect()]
        # a condition on the file's path picks the files before any is opened
        lines = lines.where(F.col("_metadata.file_path").isin(named)) if len(named) <= NAMED_FILES else lines
        if len(named) > NAMED_FILES:
            lines = lines.withColumn("file_path", F.col("_metadata.file_path")).join(files, "file_path", "left_semi")
    path_col = F.col("file_path") if "file_path" in lines.columns else F.col("_metadata.file_path").alias("file_path")
    rows = lines.select(path_col, F.col("value").alias("raw"))
    found = line_tokens("raw")
    for t in tokens:
        rows = rows.where(F.array_contains(found, t))
    timed = rows.withColumn("_time", parse_event_timestamp(event_time_text("raw", delim), compat))
    return time_range(timed, earliest, latest, now, "_time").select("file_path", "_time", "raw")
