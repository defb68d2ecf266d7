"""Registered queries of searches that skip, continue and discover, and of hostile values, with their DuckDB oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.fields import event_size, event_text
from eventloom.operators.extract import discover_fields, extract_discovered, extract_fields
from eventloom.operators.format import format_events, with_destination
from eventloom.operators.seek import next_page
from eventloom.operators.tokens import build_token_index, candidate_files, search_tokens
from eventloom.plans.catalog import (
    _EVENTS_RAW,
    _WEEK_SEARCH,
    BLOCK_SIZE,
    EVENT_FIELDS,
    NOW,
    STREAM_FILES,
    WEEK,
    Query,
    _events,
    _exported,
    _formatted_events,
    _payloads,
    _week_search,
)
from eventloom.plans.search import search_bucketed_events
from eventloom.session import scratch_path
from eventloom.sinks.partitioned import write_bucketed_events
from eventloom.sources.tables import read_table
from eventloom.streaming.delivery import read_event_stream, start_delivery, stream_totals

PAGE_ROWS = 25
RUN_GROWTH = 4  # each run of pages is so many times the one before
ODD_NAMES = {"a": "event_id", "user id": "user_id", "2nd": "event_type", "price ($)": "value", "é": "props"}


def q_search_sink_window(spark, sf):
    """Events in daily folders, one day written twice; a window reads its days."""
    path = scratch_path(spark, "bucketed")
    routed = format_events(with_destination(_events(spark, sf), index="main", sourcetype=F.col("event_type")), EVENT_FIELDS, "ts")
    write_bucketed_events(routed, path)
    write_bucketed_events(routed.where("date_format(ts, 'yyyy-MM-dd') = '2024-01-12'"), path)  # replaces that day
    hits = search_bucketed_events(spark, path, EVENT_FIELDS, "event_type = 'error' AND CAST(value AS DOUBLE) > 100", *WEEK, now=NOW)
    return hits.select("index", "sourcetype", "event_id", "event_type", "value", "props")


def q_search_page_next(spark, sf):
    """A search's results page by page, in runs of pages that grow, each run from the token of the page before."""
    hits, runs, taken, pages, token = _week_search(spark, sf), [], 0, 1, None
    while True:
        run = next_page(hits, ["event_type", "ts"], PAGE_ROWS, token, pages=pages, number="page")
        runs.append(run.rows.withColumn("page", F.col("page") + F.lit(taken)))
        if (token := run.token) is None:
            return reduce(DataFrame.unionByName, runs)
        taken, pages = taken + pages, pages * RUN_GROWTH


def _one_token(spark, sf) -> str:
    return str(_events(spark, sf).agg(F.max("event_id")).first()[0])


def q_search_token_index(spark, sf):
    """Lines with a rare token, by the index; and that fewer files were read than there are."""
    path, index = scratch_path(spark, "shipped"), scratch_path(spark, "token-index")
    _formatted_events(spark, sf).repartitionByRange(16, "event_id").select("raw").write.text(path)
    build_token_index(spark, path, index)
    tokens = [_one_token(spark, sf), "event_type"]
    fewer = candidate_files(spark, index, tokens).count() < spark.read.parquet(f"{index}/files").count()
    return search_tokens(spark, path, tokens, index).select("raw", F.lit(fewer).alias("read_fewer"))


def q_extract_discovered_fields(spark, sf):
    """Every field of the events without naming one, in the types that their values have."""
    shipped = _events(spark, sf).select(event_text(EVENT_FIELDS, "ts", escape="backslash").alias("raw"))
    return extract_discovered(shipped)


def q_discover_fields(spark, sf):
    shipped = _events(spark, sf).select(event_text(EVENT_FIELDS, "ts", escape="backslash").alias("raw"))
    return discover_fields(shipped)


def q_extract_odd_names(spark, sf):
    """Field names with spaces, digits first and signs, read back from unescaped text."""
    shipped = _events(spark, sf).select(event_text(list(ODD_NAMES.items()), "ts").alias("raw"))
    return extract_fields(shipped, list(ODD_NAMES), time_out=None)


def q_stream_totals(spark, sf):
    """Totals of each micro-batch, as observed while it was shipped."""
    src, out, ckpt = (scratch_path(spark, n) for n in ("stream-twice", "stream-out", "stream-ckpt"))
    ev = _events(spark, sf)
    for _ in range(2):
        ev.repartition(STREAM_FILES).write.mode("append").parquet(src)
    stream = read_event_stream(spark, src, ev.schema, glob="*.parquet", max_files_per_trigger=STREAM_FILES)
    start_delivery(stream, ["event_id"], out, ckpt, raw=event_text(EVENT_FIELDS, "ts"), size=event_size(EVENT_FIELDS, "ts")).awaitTermination()
    return stream_totals(spark, out)


def _hostile(spark, sf) -> DataFrame:
    """Documents whose texts hold what text formats trip over."""
    docs, k = read_table(spark, sf, "documents"), F.col("doc_id") % 8
    text = (F.when(k == 0, F.concat(F.lit("\x01\x0b"), "text", F.lit("\x1f"))).when(k == 1, F.lit("\\N")).when(k == 2, F.lit("\\\\N"))
            .when(k == 3, F.replace("text", F.lit("\n"), F.lit("\r\n"))).when(k == 4, F.concat(F.lit("\\u0041 \\u005c \""), "text", F.lit("\r")))
            .when(k == 5, F.lit("")).when(k == 6, F.concat(F.lit(" \t'<&>]]>"), "text", F.lit(chr(0xFFFF) + " \\"))))
    return docs.withColumn("text", text)


def _export_hostile(mode: str) -> Query:
    def q(spark, sf):
        return _exported(spark, _hostile(spark, sf), mode)
    q.__name__ = f"q_export_hostile_{mode}"
    return q


QUERIES: dict[str, Query] = {
    "search_sink_window": q_search_sink_window,
    "search_page_next": q_search_page_next,
    "search_token_index": q_search_token_index,
    "extract_discovered_fields": q_extract_discovered_fields,
    "discover_fields": q_discover_fields,
    "extract_odd_names": q_extract_odd_names,
    "stream_totals": q_stream_totals,
    "export_hostile_csv": _export_hostile("csv"),
    "export_hostile_json": _export_hostile("json"),
    "export_hostile_xml": _export_hostile("xml"),
}

# ---------------------------------------------------------------- DuckDB oracles

_HOSTILE = r"""SELECT * REPLACE (CASE doc_id % 8 WHEN 0 THEN chr(1) || chr(11) || text || chr(31) WHEN 1 THEN '\N' WHEN 2 THEN '\\N'
  WHEN 3 THEN replace(text, chr(10), chr(13) || chr(10)) WHEN 4 THEN chr(92) || 'u0041 ' || chr(92) || 'u005c "' || text || chr(13) WHEN 5 THEN ''
  WHEN 6 THEN ' ' || chr(9) || '''<&>]]>' || text || chr(65535) || ' \' END AS text) FROM documents"""

ORACLES: dict[str, str] = {
    "search_sink_window": (
        "SELECT 'main' AS \"index\", event_type AS sourcetype, cast(event_id AS VARCHAR) AS event_id, event_type, "
        f"cast(value AS VARCHAR) AS value, props FROM {_WEEK_SEARCH}"
    ),
    "search_page_next": (
        f"SELECT * EXCLUDE (n), (n - 1) // {PAGE_ROWS} AS page FROM "
        f"(SELECT *, row_number() OVER (ORDER BY event_type, ts, event_id, user_id, value, props) AS n FROM {_WEEK_SEARCH})"
    ),
    "search_token_index": (
        f"SELECT raw, true AS read_fewer FROM {_EVENTS_RAW} WHERE list_contains(regexp_extract_all(lower(raw), '[a-z0-9_]+'), "
        "(SELECT cast(max(event_id) AS VARCHAR) FROM events))"
    ),
    "extract_discovered_fields": f"SELECT date_trunc('millisecond', ts) AS _time, {', '.join(EVENT_FIELDS)} FROM events",
    "discover_fields": (
        "SELECT unnest(['event_id', 'user_id', 'event_type', 'value', 'props']) AS name, count(*) AS n_events, "
        "unnest(['bigint', 'bigint', 'string', 'double', 'string']) AS type FROM events"
    ),
    "extract_odd_names": "SELECT " + ", ".join(f"cast({c} AS VARCHAR) AS \"{n}\"" for n, c in ODD_NAMES.items()) + " FROM events",
    "stream_totals": (
        "SELECT unnest([0, 1])::BIGINT AS stream_batch_id, sum(n_bytes)::BIGINT AS read_bytes, sum(n_bytes)::BIGINT AS sent_bytes, "
        "count(*) AS batches, 0::BIGINT AS rejected, sum(n_events)::BIGINT AS n_events FROM "
        + _payloads(_EVENTS_RAW, "", "event_id", BLOCK_SIZE)
    ),
    "export_hostile_csv": _HOSTILE,
    "export_hostile_json": _HOSTILE,
    "export_hostile_xml": _HOSTILE,
}
