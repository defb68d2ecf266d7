"""Event sinks partitioned by destination (``index``/``sourcetype`` folders)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.prefix import DEFAULT_BROADCAST_ROWS, _null_safe_join, row_width
from eventloom.session import checkpoint_root

DEFAULT_PARTITIONS = ("index", "sourcetype")
DEFAULT_ROWS_PER_FILE = 5_000_000
DEFAULT_BYTES_PER_FILE = 128 * 1024 * 1024


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def write_events(df: DataFrame, path: str, partition_by: Sequence[str] = DEFAULT_PARTITIONS,
                 fmt: str = "text", raw: str = "raw", mode: str = "overwrite",
                 rows_per_file: int | None = DEFAULT_ROWS_PER_FILE,
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS, max_tasks: int | None = None,
                 dynamic: bool = False, bytes_per_file: int | None = DEFAULT_BYTES_PER_FILE) -> None:
    """Write event text (``fmt='text'``, one line per event) or whole rows
    (``parquet``) into one folder per destination.

    With ``rows_per_file``, rows are first clustered so each destination is
    written by ``ceil(rows / rows_per_file)`` tasks, or ``ceil(bytes / bytes_per_file)`` if these are
    more (a writing task sorts its rows, so its memory follows their bytes): a destination holding a
    third of the data is spread evenly instead of landing in one task, and a
    small one becomes one file instead of one per input task. The per-destination
    counts table is checkpointed, measured and broadcast only within its limits.
    A row goes to one of its destination's tasks by its place in its input task, not by
    its values, so equal rows spread like any others; pass a scan or a stored table, whose
    row order a recomputed task keeps. ``max_tasks`` bounds the tasks
    where the caller has a reason to; by default their number follows the rows.
    ``rows_per_file=None`` writes straight from the input tasks. ``dynamic`` with mode
    ``overwrite`` replaces only the folders that ``df`` has rows for.
    """
    parts = list(partition_by)
    out = df.select(*parts, raw) if fmt == "text" else df
    if parts and rows_per_file:
        checkpoint_root(df.sparkSession)
        files = [F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file))]
        if bytes_per_file:
            held = F.sum(row_width(out.drop(*parts)).cast("long"))
            files.append(F.coalesce(F.ceil(held / F.lit(bytes_per_file)), F.lit(1)))
        groups = out.groupBy(*parts).agg(F.greatest(*files).cast("long").alias("_groups")).checkpoint(eager=True)
        total, most = groups.agg(F.sum("_groups"), F.count(F.lit(1))).first()
        # as many tasks as full files; small destinations share them
        n_tasks = max(1, int(total or 1) - int(most or 0) + min(int(most or 0), _shuffle_partitions(df)))
        n_tasks = min(max_tasks, n_tasks) if max_tasks else n_tasks
        salted = _null_safe_join(out, groups, parts, "inner", broadcast_rows)
        salted = salted.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.col("_groups")))
        # one task per (destination, salt) group, up to hash collisions; a fixed
        # count, so adaptive execution does not merge the groups back together
        out = salted.repartition(n_tasks, *parts, "_salt").drop("_salt", "_groups")
    writer = out.write.mode(mode).partitionBy(*parts).format(fmt)
    (writer.option("partitionOverwriteMode", "dynamic") if dynamic else writer).save(path)


def read_events(spark: SparkSession, path: str, fmt: str = "text", raw: str = "raw",
                partition_by: Sequence[str] = DEFAULT_PARTITIONS) -> DataFrame:
    """Read a partitioned event sink back. For text, the partition columns are
    declared as strings in the read schema, so destination values such as ``007``
    come back unchanged (no type inference, no session setting touched)."""
    reader = spark.read.option("basePath", path)
    if fmt == "text":
        cols = ", ".join(["value string", *[f"`{p}` string" for p in partition_by]])
        return reader.schema(cols).text(path).withColumnRenamed("value", raw)
    return reader.format(fmt).load(path)


#: Formats of a time bucket's folder name: text that sorts as the times do.
BUCKETS = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}
BUCKET = "bucket"


def write_bucketed_events(df: DataFrame, path: str, time_col: str = "ts", unit: str = "day",
                          partition_by: Sequence[str] = DEFAULT_PARTITIONS, **how) -> None:
    """:func:`write_events` with a folder for each ``unit`` of ``time_col`` (session time zone) above the
    destinations' ones; rows without a time go to Spark's null folder. Buckets that ``df`` has no rows for are left alone,
    so a day that is written again replaces itself."""
    bucketed = df.withColumn(BUCKET, F.date_format(time_col, BUCKETS[unit]))
    write_events(bucketed, path, (BUCKET, *partition_by), dynamic=True, **how)


def bucket_range(earliest, latest, unit: str = "day"):
    """The condition on the bucket column for ``earliest <= time < latest`` (wall-clock datetimes or None): it holds
    for every bucket that may have such a time, and is a partition filter."""
    name = {"day": "%Y-%m-%d", "hour": "%Y-%m-%d-%H"}[unit]
    c = F.col(BUCKET)
    conditions = [c >= earliest.strftime(name)] if earliest else []
    if latest:  # the bucket of the last instant before it
        conditions.append(c <= (latest - dt.timedelta(microseconds=1)).strftime(name))
    return conditions
