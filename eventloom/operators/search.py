"""Search: time-bounded predicate filter, job counters, paging, dequote.

A search is a Spark SQL boolean expression plus an ``[earliest, latest)`` time
window resolved against an explicit ``now``. Bounds become literals of the time
column's own type, so Catalyst folds them and pushes them into the scan. A bad
expression fails at once (``ParseException`` / ``AnalysisException``) before any
job runs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType

from eventloom.functions.lines import dequote
from eventloom.functions.timerange import DEFAULT_EARLIEST, DEFAULT_LATEST, now_in, resolve_time


def _time_literal(df: DataFrame, time_col: str, t: dt.datetime) -> Column:
    text = F.lit(t.isoformat(sep=" ", timespec="microseconds"))
    kind = df.schema[time_col].dataType
    return text.cast("timestamp_ntz") if isinstance(kind, TimestampNTZType) else text.cast("timestamp")


def _predicate(pred: str | Column | None) -> Column | None:
    if pred is None:
        return None
    if isinstance(pred, Column):
        return pred
    return F.expr(pred) if pred.strip() else None


def time_bounds(
    earliest: str | dt.datetime | None = DEFAULT_EARLIEST,
    latest: str | dt.datetime | None = DEFAULT_LATEST,
    now: dt.datetime | str | None = None,
    zone: str = "UTC",
) -> tuple[dt.datetime | None, dt.datetime | None]:
    """Resolve both modifiers against one ``now`` (the current time if not given),
    as wall-clock times in ``zone``."""
    now_t = now if now is not None else now_in(zone)
    return resolve_time(earliest, now_t, zone), resolve_time(latest, now_t, zone)


def session_zone(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone", "UTC")


def time_range(
    df: DataFrame,
    earliest: str | dt.datetime | None = DEFAULT_EARLIEST,
    latest: str | dt.datetime | None = DEFAULT_LATEST,
    now: dt.datetime | str | None = None,
    time_col: str = "ts",
) -> DataFrame:
    """Rows with ``earliest <= time_col < latest``; a ``None``/blank bound is open.
    Bounds are wall-clock times in the session time zone."""
    lo, hi = time_bounds(earliest, latest, now, session_zone(df))
    out = df
    if lo is not None:
        out = out.where(F.col(time_col) >= _time_literal(df, time_col, lo))
    if hi is not None:
        out = out.where(F.col(time_col) < _time_literal(df, time_col, hi))
    return out


def search(
    df: DataFrame,
    predicate: str | Column | None = None,
    earliest: str | dt.datetime | None = DEFAULT_EARLIEST,
    latest: str | dt.datetime | None = DEFAULT_LATEST,
    now: dt.datetime | str | None = None,
    time_col: str = "ts",
) -> DataFrame:
    """Time window, then the predicate. Both reach the parquet scan as pushed filters."""
    out = time_range(df, earliest, latest, now, time_col)
    p = _predicate(predicate)
    return out.where(p) if p is not None else out


def search_stats(
    df: DataFrame,
    predicate: str | Column | None = None,
    earliest: str | dt.datetime | None = DEFAULT_EARLIEST,
    latest: str | dt.datetime | None = DEFAULT_LATEST,
    now: dt.datetime | str | None = None,
    time_col: str = "ts",
    offset: int = 0,
    count: int = 0,
) -> DataFrame:
    """One row: ``scan_count`` (rows in the time window), ``event_count`` (rows that
    match), ``result_count`` (rows the page returns). One aggregation pass; the
    time window is still pushed down because nothing wraps the filter."""
    scanned = time_range(df, earliest, latest, now, time_col)
    p = _predicate(predicate)
    matched = F.count_if(p) if p is not None else F.count(F.lit(1))
    agg = scanned.agg(F.count(F.lit(1)).cast("long").alias("scan_count"), matched.cast("long").alias("event_count"))
    after = F.greatest(F.col("event_count") - F.lit(offset), F.lit(0))
    result = F.least(after, F.lit(count)) if count > 0 else after
    return agg.select("scan_count", "event_count", result.cast("long").alias("result_count"))


# Largest page (offset + count) served as a top-k; beyond it rows are numbered.
TOPK_ROWS = 100_000


def full_order(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    """``order_by``, then every other column that can be ordered: rows that tie in all of
    them are equal, so that pages taken by separate calls neither skip nor repeat any."""
    rest = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and f.name not in order_by]
    return [*order_by, *[c for c in rest if df.schema[c].dataType.simpleString() not in ("variant", "interval")]]


def page(df: DataFrame, order_by: Sequence[str], offset: int = 0, count: int = 0,
         topk_rows: int = TOPK_ROWS, number: str | None = None) -> DataFrame:
    """Rows ``offset .. offset+count`` in ``order_by`` order; ``count=0`` means all.

    The result is sorted whatever its size, ties by the other columns. A small page
    (``offset + count <= topk_rows``) is a top-k: each task keeps ``offset + count``
    rows. Anything else (a large offset, or an offset with no count) numbers the rows
    with the two-level running sum, keeps the range and sorts what it kept, so no
    step gathers the result into one task or the driver. ``number`` names a column
    for the row's number in the order, from 1; it takes the second way.
    """
    if offset < 0 or count < 0:
        raise ValueError("offset and count must be >= 0")
    order = full_order(df, order_by)
    if number is None:
        if count and offset + count <= topk_rows:
            return df.orderBy(*order).offset(offset).limit(count) if offset else df.orderBy(*order).limit(count)
        if not offset and not count:
            return df.orderBy(*order)
    from eventloom.operators.prefix import running_sum

    row = number or "_row"
    numbered = running_sum(df, F.lit(1), order, out=row)
    keep = F.col(row) > offset
    if count:
        keep = keep & (F.col(row) <= offset + count)
    return numbered.where(keep).orderBy(row).select(*df.columns, *([number] if number else []))


def dequote_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Remove surrounding double quotes from string columns (all of them by default)."""
    targets = set(cols) if cols is not None else {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    return df.select(*[dequote(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def is_empty(df: DataFrame) -> bool:
    """The empty-result rule: callers return before opening any output."""
    return df.isEmpty()
