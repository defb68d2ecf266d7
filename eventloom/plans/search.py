"""End-to-end search: time window + predicate -> counters -> page -> export."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from eventloom.functions.timerange import DEFAULT_EARLIEST, DEFAULT_LATEST
from eventloom.functions.timerange import now_in
from eventloom.operators.format import format_events
from eventloom.operators.search import dequote_columns, page, search, search_stats, session_zone, time_bounds
from eventloom.sinks.export import export_results


@dataclass(frozen=True)
class SearchResult:
    scan_count: int
    event_count: int
    result_count: int
    path: str | None  # None: nothing written (zero results)


def run_search(
    df: DataFrame,
    predicate: str | Column | None,
    out_path: str,
    mode: str = "csv",
    earliest: str | dt.datetime | None = DEFAULT_EARLIEST,
    latest: str | dt.datetime | None = DEFAULT_LATEST,
    now: dt.datetime | str | None = None,
    time_col: str = "ts",
    order_by: Sequence[str] | None = None,
    offset: int = 0,
    count: int = 0,
    dequote: bool = False,
) -> SearchResult:
    """Counters first (one aggregation job); with zero results nothing is opened or
    written. Otherwise the page is exported in ``mode``; ``dequote`` removes
    surrounding double quotes from the exported string fields. ``raw`` writes a
    ``raw`` column, or each row formatted as event text when there is none."""
    now = now if now is not None else now_in(session_zone(df))
    stats = search_stats(df, predicate, earliest, latest, now, time_col, offset, count).first()
    if stats["result_count"] == 0:
        return SearchResult(stats["scan_count"], stats["event_count"], 0, None)
    hits = search(df, predicate, earliest, latest, now, time_col)
    if offset or count:
        hits = page(hits, order_by or [time_col], offset, count)
    if dequote:
        hits = dequote_columns(hits)
    if mode == "raw" and "raw" not in hits.columns:
        hits = format_events(hits, ts=time_col, keep=False)  # rows written as event text
    path = export_results(hits, out_path, mode, check_empty=False)
    return SearchResult(stats["scan_count"], stats["event_count"], stats["result_count"], path)


def search_event_files(
    spark,
    path: str | list[str],
    fields: Sequence[str],
    predicate: str | Column | None = None,
    earliest: str | dt.datetime | None = DEFAULT_EARLIEST,
    latest: str | dt.datetime | None = DEFAULT_LATEST,
    now: dt.datetime | str | None = None,
    delim: str = "|",
    escape: str = "none",
    compat: bool = False,
    partitions: Sequence[str] = (),
) -> DataFrame:
    """Search shipped event text: lines of event files, ``fields`` read out of the
    text (strings) plus the event time ``_time``, then the time window on ``_time``
    and the predicate (cast string fields in it as needed). Lines without a stamp have
    no ``_time``: they match only where both bounds are open.

    ``partitions`` names the folder columns of an event sink (``path`` is its root);
    conditions on them in the predicate prune its folders."""
    from eventloom.operators.extract import extract_fields
    from eventloom.sinks.partitioned import read_events
    from eventloom.sources.text import read_event_file

    if partitions:
        lines = read_events(spark, path, partition_by=partitions)
    else:
        lines = read_event_file(spark, path)
    extracted = extract_fields(lines, list(fields), delim=delim, escape=escape, compat=compat,
                               keep=list(partitions) or ["file_path"])
    return search(extracted, predicate, earliest, latest, now, time_col="_time")


def search_bucketed_events(
    spark,
    path: str,
    fields: Sequence[str],
    predicate: str | Column | None = None,
    earliest: str | dt.datetime | None = DEFAULT_EARLIEST,
    latest: str | dt.datetime | None = DEFAULT_LATEST,
    now: dt.datetime | str | None = None,
    unit: str = "day",
    partitions: Sequence[str] = ("index", "sourcetype"),
    delim: str = "|",
    escape: str = "none",
    compat: bool = False,
) -> DataFrame:
    """Search a sink of :func:`eventloom.sinks.partitioned.write_bucketed_events`: the time window picks the
    bucket folders that are read, and then the events by the time in their text."""
    from eventloom.operators.extract import extract_fields
    from eventloom.sinks.partitioned import BUCKET, bucket_range, read_events

    lines = read_events(spark, path, partition_by=(BUCKET, *partitions))
    now = now if now is not None else now_in(session_zone(lines))
    for condition in bucket_range(*time_bounds(earliest, latest, now, session_zone(lines)), unit):
        lines = lines.where(condition)
    extracted = extract_fields(lines, list(fields), delim=delim, escape=escape, compat=compat, keep=list(partitions))
    return search(extracted, predicate, earliest, latest, now, time_col="_time")
