"""The registered queries: one Spark plan per operator, each with its DuckDB oracle.

Every query reads the driver's tables (or data Spark derives from them and
writes below the shared checkpoint folder) in full. Parameters are fixed here,
once, for all queries: the search clock ``NOW``, the reference block size and
payload limit, and the small block size / limit of the dead-letter query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.fields import event_size, event_text
from eventloom.functions.lines import array_payload, byte_length
from eventloom.functions.timefmt import event_timestamp
from eventloom.operators.batching import (
    BLOCK_SIZE,
    MAX_PAYLOAD,
    assign_batches,
    batch_events,
    batch_of,
    oversize,
    value_payloads,
    ship_totals,
)
from eventloom.operators.extract import extract_fields
from eventloom.operators.format import (
    destination_query_string,
    format_default_events,
    format_event_maps,
    format_events,
    raw_events,
    with_destination,
)
from eventloom.operators.lines import normalize_lines
from eventloom.operators.prefix import running_sums
from eventloom.operators.search import dequote_columns, page, search, search_stats
from eventloom.plans.search import run_search, search_event_files
from eventloom.plans.ship import file_batches, ship, table_batches
from eventloom.session import scratch_path
from eventloom.sinks.deliver import deliver
from eventloom.sinks.export import export_results, read_export
from eventloom.sinks.partitioned import read_events, write_events
from eventloom.sources.tables import read_table
from eventloom.sources.text import FILE_ORDER, FILE_SEGMENT, events_from_array, lines_from_text, read_event_file
from eventloom.streaming.delivery import read_event_file_stream, read_event_stream, read_stream_receipts, start_delivery

Query = Callable[[SparkSession, str], DataFrame]

# Fixed query parameters.
EVENT_FIELDS = ["event_id", "user_id", "event_type", "value", "props"]
LINEITEM_FIELDS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]  # unique; the first two are not
DOC_FIELDS = ["doc_id", "lang", "source", "text"]
NOW = "2024-01-16T09:30:00"
PREDICATE = "event_type = 'error' AND value > 100"
WEEK = ("-7d@d", "@d")
PAGE_OFFSET, PAGE_COUNT = 10, 25
SMALL_BLOCK, SMALL_LIMIT = 8_192, 16_384
HOT_SPLIT_ROWS = 10_000  # destinations above this are cut into segments
BIG = 1 << 60  # added to order keys, where doubles are 256 apart
LARGE_OFFSET, LARGE_COUNT = 120, 400
STREAM_FILES = 4


# ---------------------------------------------------------------- Spark side

def _events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


def _formatted_events(spark: SparkSession, sf: str, escape: str = "none") -> DataFrame:
    return format_events(_events(spark, sf), EVENT_FIELDS, "ts", escape=escape)


def q_event_timestamp(spark, sf):
    return _events(spark, sf).select("event_id", event_timestamp("ts").alias("ts_text"))


def q_event_timestamp_compat(spark, sf):
    return _events(spark, sf).select("event_id", event_timestamp("ts", compat=True).alias("ts_text"))


def q_format_event_fields(spark, sf):
    return _formatted_events(spark, sf).select("event_id", "raw")


def q_format_event_map(spark, sf):
    ev = _events(spark, sf).withColumn("props_map", F.from_json("props", "map<string,string>"))
    return format_event_maps(ev, "props_map", "ts").select("event_id", "raw")


def q_format_event_default(spark, sf):
    return format_default_events(_events(spark, sf), EVENT_FIELDS, "ts").select("event_id", "raw")


def _routed_events(spark, sf):
    ev = _events(spark, sf)
    return with_destination(
        ev, index="main", source="", sourcetype=F.nullif(F.col("event_type"), F.lit("view")),
        defaults={"source": "events", "sourcetype": "generic"},
    )


def q_event_metadata(spark, sf):
    return _routed_events(spark, sf).select(
        "event_id", "index", "source", "sourcetype", destination_query_string().alias("query_string"))


def _lineitem_routed(spark, sf, dest_col):
    li = read_table(spark, sf, "lineitem")
    return with_destination(li, sourcetype=F.col(dest_col))


def lineitem_text():
    return event_text(LINEITEM_FIELDS, "l_shipdate")


def lineitem_size():
    return event_size(LINEITEM_FIELDS, "l_shipdate")


def q_batch_assign(spark, sf):
    assigned = assign_batches(_lineitem_routed(spark, sf, "l_returnflag"), LINEITEM_ORDER, BLOCK_SIZE,
                              raw=lineitem_text(), size=lineitem_size())
    return assigned.select(*LINEITEM_ORDER, "sourcetype", "batch_id")


def q_batch_assign_hot(spark, sf):
    """As ``batch_assign``, with every destination above 10,000 rows cut into
    quantile segments (the path a destination holding much of the data takes)."""
    assigned = assign_batches(_lineitem_routed(spark, sf, "l_returnflag"), LINEITEM_ORDER, BLOCK_SIZE,
                              raw=lineitem_text(), size=lineitem_size(), split_rows=HOT_SPLIT_ROWS)
    return assigned.select(*LINEITEM_ORDER, "sourcetype", "batch_id")


def _lineitem_payloads(spark, sf):
    return table_batches(_lineitem_routed(spark, sf, "l_linestatus"), LINEITEM_ORDER, LINEITEM_FIELDS,
                         "l_shipdate")


def q_batch_payload(spark, sf):
    return _lineitem_payloads(spark, sf).select("sourcetype", "batch_id", "n_events", "n_bytes", "payload")


def q_oversize_batches(spark, sf):
    docs = format_events(read_table(spark, sf, "documents"), DOC_FIELDS, ts=False)
    payloads = batch_events(docs, ["doc_id"], SMALL_BLOCK, destination=[])
    return payloads.select("batch_id", "n_events", "n_bytes", oversize(payloads, SMALL_LIMIT).alias("rejected"))


def q_ship_totals(spark, sf):
    return ship_totals(_lineitem_payloads(spark, sf), MAX_PAYLOAD).select(
        "sourcetype", "read_bytes", "sent_bytes", "calls", "rejected", "n_events")


def q_read_event_file(spark, sf):
    """Events written as text files (ordered ranges), read back in file order, then
    numbered and batched in one two-level pass over the file's own segments."""
    path = scratch_path(spark, "event-file")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (_formatted_events(spark, sf).repartitionByRange(n, "event_id").sortWithinPartitions("event_id")
        .select("raw").write.text(path))
    lines = read_event_file(spark, path)
    sums = running_sums(lines, {"_n": F.lit(1), "_cum": byte_length("raw") + 1}, list(FILE_ORDER),
                        segment=list(FILE_SEGMENT))
    return sums.select((F.col("_n") - 1).alias("line_no"), batch_of("_cum", BLOCK_SIZE).alias("batch_id"), "raw")


def q_format_event_escaped(spark, sf):
    """Documents (quotes, backslashes, line breaks, non-ASCII) as backslash-escaped events."""
    docs = format_events(read_table(spark, sf, "documents"), DOC_FIELDS, ts=False, escape="backslash")
    return docs.select("doc_id", "raw")


def q_file_receipts(spark, sf):
    """Events written as ordered text files, cut into payloads in file order and
    delivered (test sender: MD5 of the payload)."""
    path = scratch_path(spark, "event-file")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (_formatted_events(spark, sf).repartitionByRange(n, "event_id").sortWithinPartitions("event_id")
        .select("raw").write.text(path))
    receipts = deliver(file_batches(spark, path, BLOCK_SIZE, per_file=False))
    return receipts.select("batch_id", "n_events", "n_bytes", "status")


def q_event_lines_from_text(spark, sf):
    docs = read_table(spark, sf, "documents")
    return lines_from_text(docs, "text").select("doc_id", "line_no", "line")


def q_text_payloads(spark, sf):
    """Each document's text as one request (lines re-ended by LF), with the oversize flag."""
    p = value_payloads(read_table(spark, sf, "documents"), "text", ["doc_id"])
    return p.select("doc_id", "n_events", "n_bytes", "payload", oversize(p, SMALL_LIMIT).alias("rejected"))


def q_event_array_payload(spark, sf):
    conv = raw_events(read_table(spark, sf, "conversations"), F.col("text"))
    payloads = batch_events(conv, ["turn"], MAX_PAYLOAD, destination=["conv_id"])
    return payloads.select("conv_id", "batch_id", "n_events", "n_bytes", "payload")


def q_normalize_lines(spark, sf):
    docs = format_events(read_table(spark, sf, "documents"), ["doc_id", "lang", "text"], ts=False)
    return normalize_lines(docs, "raw").select("doc_id", "line_no", "line")


def _week_search(spark, sf):
    return search(_events(spark, sf), PREDICATE, *WEEK, now=NOW)


def q_search_time_range(spark, sf):
    return search(_events(spark, sf), None, "-1d@d", "@d", now=NOW)


def q_search_predicate(spark, sf):
    return _week_search(spark, sf)


def q_search_stats(spark, sf):
    return search_stats(_events(spark, sf), PREDICATE, *WEEK, now=NOW, offset=PAGE_OFFSET, count=PAGE_COUNT)


def q_search_page(spark, sf):
    return page(_week_search(spark, sf), ["ts", "event_id"], PAGE_OFFSET, PAGE_COUNT)


def q_dequote_output(spark, sf):
    """The ``name="value"`` tokens of every event, values shown without their quotes."""
    raw = _formatted_events(spark, sf)
    tokens = raw.select("event_id", F.posexplode(F.expr("slice(split(raw, '[|]'), 2, size(split(raw, '[|]')))")).alias("pos", "tok"))
    shown = tokens.select(
        "event_id", F.col("pos").cast("long").alias("pos"),
        F.substring_index("tok", "=", 1).alias("field"),
        F.expr("substring(tok, instr(tok, '=') + 1)").alias("value"),
    )
    return dequote_columns(shown, ["value"])


def q_extract_fields(spark, sf):
    return extract_fields(_formatted_events(spark, sf), EVENT_FIELDS)


def q_extract_fields_escaped(spark, sf):
    docs = format_events(read_table(spark, sf, "documents"), DOC_FIELDS, ts=False, escape="backslash")
    return extract_fields(docs, DOC_FIELDS, escape="backslash", time_out=None)


def q_search_raw_events(spark, sf):
    """Search what was shipped: event text files read back, fields extracted from
    the text, then the time window (on the extracted ``_time``) and the predicate."""
    path = scratch_path(spark, "shipped")
    _formatted_events(spark, sf).select("raw").write.text(path)
    hits = search_event_files(spark, path, EVENT_FIELDS, "event_type = 'error' AND CAST(value AS DOUBLE) > 100",
                              *WEEK, now=NOW)
    return hits.select("event_id", "event_type", "value", "props")


def q_delivery_receipts(spark, sf):
    receipts = deliver(_lineitem_payloads(spark, sf), shipment="lineitem")
    return receipts.select("sourcetype", "batch_id", "n_events", "n_bytes", "batch_key", "status")


def q_stream_delivery(spark, sf):
    ev = _events(spark, sf)
    stream = read_event_stream(spark, sf, ev.schema, glob="events.parquet")
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = start_delivery(stream, ["event_id"], out, ckpt, keep_payloads=True,
                       raw=event_text(EVENT_FIELDS, "ts"), size=event_size(EVENT_FIELDS, "ts"))
    q.awaitTermination()
    payloads = spark.read.parquet(f"{out}/payloads")
    lines = payloads.select(F.explode(F.split(F.regexp_replace("payload", "\n\\z", ""), "\n")).alias("raw"))
    return lines


def q_stream_file_delivery(spark, sf):
    """Files of event lines shipped by a stream in file order; payload lines read back
    with their batch, which must follow the file's line order."""
    src = scratch_path(spark, "stream-files")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (_formatted_events(spark, sf).repartitionByRange(n, "event_id").sortWithinPartitions("event_id")
        .select("raw").write.text(src))
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = start_delivery(read_event_file_stream(spark, src, glob="*.txt"), [], out, ckpt, keep_payloads=True,
                       file_lines=True, per_file=False)
    q.awaitTermination()
    payloads = spark.read.parquet(f"{out}/payloads")
    return payloads.select("batch_id", F.explode(F.split(F.regexp_replace("payload", "\n\\z", ""), "\n"))
                           .alias("raw"))


def q_event_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "event-sink")
    routed = format_events(with_destination(_events(spark, sf), index="main", sourcetype=F.col("event_type")),
                           EVENT_FIELDS, "ts")
    write_events(routed, path, ("index", "sourcetype"), fmt="text")
    return read_events(spark, path).select("index", "sourcetype", "raw")


def _exported(spark, df: DataFrame, mode: str) -> DataFrame:
    path = scratch_path(spark, f"export-{mode}")
    written = export_results(df, path, mode)
    if written is None:
        return spark.createDataFrame([], df.schema)
    return read_export(spark, written, mode, None if mode == "raw" else df.schema)


def _export(mode: str) -> Query:
    """All events, written and read back."""
    def q(spark, sf):
        hits = _events(spark, sf)
        return _exported(spark, format_events(hits, EVENT_FIELDS, "ts", keep=False) if mode == "raw" else hits, mode)
    q.__name__ = f"q_export_{mode}"
    return q


def _export_documents(mode: str) -> Query:
    """All documents (line breaks, quotes, several scripts), written and read back."""
    def q(spark, sf):
        return _exported(spark, read_table(spark, sf, "documents"), mode)
    q.__name__ = f"q_export_documents_{mode}"
    return q


def q_batch_assign_big_keys(spark, sf):
    """Order keys that doubles cannot tell apart, with the destinations cut."""
    li = _lineitem_routed(spark, sf, "l_returnflag").withColumn("big_key", F.col("l_orderkey") + F.lit(BIG))
    order = ["big_key", *LINEITEM_ORDER[1:]]
    assigned = assign_batches(li, order, BLOCK_SIZE, raw=lineitem_text(), size=lineitem_size(), split_rows=HOT_SPLIT_ROWS)
    return assigned.select(*order, "sourcetype", "batch_id")


def q_batch_assign_string_key(spark, sf):
    """A text order key with a long common prefix, with the destinations cut."""
    key = F.concat(F.lit("orders/line-"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0"),
                   *[F.lpad(F.col(c).cast("string"), 9, "0") for c in LINEITEM_ORDER[1:]])
    li = _lineitem_routed(spark, sf, "l_returnflag").withColumn("text_key", key)
    assigned = assign_batches(li, ["text_key"], BLOCK_SIZE, raw=lineitem_text(), size=lineitem_size(),
                              split_rows=HOT_SPLIT_ROWS)
    return assigned.select("text_key", "sourcetype", "batch_id")


def q_batch_null_events(spark, sf):
    """Conversations as event arrays with some null events (sent as ``null``)."""
    conv = read_table(spark, sf, "conversations").withColumn(
        "raw", F.when((F.col("conv_id") + F.col("turn")) % 3 != 0, F.col("text")))
    payloads = batch_events(conv, ["turn"], SMALL_BLOCK, destination=["conv_id"])
    return payloads.select("conv_id", "batch_id", "n_events", "n_bytes", "payload")


def q_batch_payload_normalized(spark, sf):
    """Documents with CRLF line ends; payloads hold LFs only."""
    docs = read_table(spark, sf, "documents").withColumn("raw", F.replace("text", F.lit("\n"), F.lit("\r\n")))
    return batch_events(docs, ["doc_id"], BLOCK_SIZE, destination=[]).select("batch_id", "n_events", "n_bytes", "payload")


def q_batch_payload_hot(spark, sf):
    """As ``batch_payload``, with both destinations cut into segments."""
    payloads = table_batches(_lineitem_routed(spark, sf, "l_linestatus"), LINEITEM_ORDER, LINEITEM_FIELDS, "l_shipdate",
                             split_rows=HOT_SPLIT_ROWS)
    return payloads.select("sourcetype", "batch_id", "n_events", "n_bytes", "payload")


def q_multi_file_batches(spark, sf):
    """Events written as a file for each type; every file has batches of its own."""
    path = scratch_path(spark, "event-files")
    (_formatted_events(spark, sf).repartition("event_type").sortWithinPartitions("event_type", "event_id")
        .select("event_type", "raw").write.partitionBy("event_type").text(path))
    payloads = file_batches(spark, path, BLOCK_SIZE)
    return payloads.select(F.regexp_extract("file_path", "event_type=([^/]*)/", 1).alias("event_type"), "batch_id",
                           "n_events", "n_bytes", F.md5("payload").alias("payload_md5"))


def q_array_payloads(spark, sf):
    docs = read_table(spark, sf, "documents")
    return docs.select("doc_id", array_payload(F.split("text", "\n")).alias("payload"))


def q_array_events(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("events"))
    return events_from_array(docs, "events").select("doc_id", "pos", "raw")


def q_dead_letters(spark, sf):
    """What ``ship`` keeps back: batches over the limit, with their text."""
    docs = format_events(read_table(spark, sf, "documents"), DOC_FIELDS, ts=False)
    _, rejected, _ = ship(batch_events(docs, ["doc_id"], SMALL_BLOCK, destination=[]), limit=SMALL_LIMIT)
    return rejected.select("batch_id", "n_events", "n_bytes", "dead_letter")


def q_stream_receipts(spark, sf):
    """The same events twice, as two micro-batches: equal payloads, a key for each."""
    src = scratch_path(spark, "stream-twice")
    ev = _events(spark, sf)
    for _ in range(2):
        ev.repartition(STREAM_FILES).write.mode("append").parquet(src)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = start_delivery(read_event_stream(spark, src, ev.schema, glob="*.parquet", max_files_per_trigger=STREAM_FILES),
                       ["event_id"], out, ckpt, raw=event_text(EVENT_FIELDS, "ts"), size=event_size(EVENT_FIELDS, "ts"))
    q.awaitTermination()
    receipts = read_stream_receipts(spark, out)
    keys = receipts.groupBy("batch_id", "status").agg(F.countDistinct("batch_key").alias("n_keys"))
    return receipts.join(keys, ["batch_id", "status"]).select(
        F.col("stream_batch_id").cast("long").alias("stream_batch_id"), "batch_id", "n_events", "n_bytes", "status", "n_keys")


def q_search_page_large(spark, sf):
    """A page beyond the top-k limit, with each row's number."""
    return page(_events(spark, sf), ["ts"], LARGE_OFFSET, LARGE_COUNT, topk_rows=PAGE_COUNT, number="row_no")


def q_search_empty_result(spark, sf):
    """A search that finds nothing writes nothing."""
    found = run_search(_events(spark, sf), "event_type = 'no such type'", scratch_path(spark, "export-none"), "csv",
                       *WEEK, now=NOW)
    return spark.createDataFrame([(found.scan_count, found.event_count, found.result_count, found.path is not None)],
                                 "scan_count long, event_count long, result_count long, written boolean")


def q_extract_fields_compat(spark, sf):
    shipped = _events(spark, sf).select(event_text(EVENT_FIELDS, "ts", compat=True).alias("raw"))
    return extract_fields(shipped, EVENT_FIELDS, compat=True)


def q_search_raw_mixed(spark, sf):
    """Event files in which some lines are no events."""
    path = scratch_path(spark, "mixed")
    lines = _formatted_events(spark, sf).select("event_id", "raw")
    stray = lines.where("event_id % 7 = 0").select("event_id", F.concat(F.lit("no stamp "), "event_id").alias("raw"))
    lines.union(stray).select("raw").write.text(path)
    hits = search_event_files(spark, path, EVENT_FIELDS, None, None, None, now=NOW)
    return hits.select("event_id", "event_type", "_time")


def q_event_sink_hot(spark, sf):
    """One line repeated for every line item, all for one destination."""
    path = scratch_path(spark, "event-sink-hot")
    same = read_table(spark, sf, "lineitem").select(
        F.lit("main").alias("index"), F.lit("hot").alias("sourcetype"), F.lit("the same line").alias("raw"))
    write_events(same, path, rows_per_file=HOT_SPLIT_ROWS)
    return read_events(spark, path).groupBy("index", "sourcetype", "raw").agg(F.count("*").alias("n"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Events routed by type, formatted, cut into request payloads."""
    payloads = table_batches(_routed_events(spark, sf), ["event_id"], EVENT_FIELDS, "ts")
    return payloads.select("index", "source", "sourcetype", "batch_id", "n_events", "n_bytes",
                           F.md5("payload").alias("payload_md5"))


QUERIES: dict[str, Query] = {
    "event_timestamp": q_event_timestamp,
    "event_timestamp_compat": q_event_timestamp_compat,
    "format_event_fields": q_format_event_fields,
    "format_event_map": q_format_event_map,
    "format_event_default": q_format_event_default,
    "event_metadata": q_event_metadata,
    "batch_assign": q_batch_assign,
    "batch_assign_hot": q_batch_assign_hot,
    "batch_payload": q_batch_payload,
    "oversize_batches": q_oversize_batches,
    "ship_totals": q_ship_totals,
    "read_event_file": q_read_event_file,
    "format_event_escaped": q_format_event_escaped,
    "file_receipts": q_file_receipts,
    "event_lines_from_text": q_event_lines_from_text,
    "text_payloads": q_text_payloads,
    "event_array_payload": q_event_array_payload,
    "normalize_lines": q_normalize_lines,
    "search_time_range": q_search_time_range,
    "search_predicate": q_search_predicate,
    "search_stats": q_search_stats,
    "search_page": q_search_page,
    "dequote_output": q_dequote_output,
    "extract_fields": q_extract_fields,
    "extract_fields_escaped": q_extract_fields_escaped,
    "search_raw_events": q_search_raw_events,
    "delivery_receipts": q_delivery_receipts,
    "stream_delivery": q_stream_delivery,
    "stream_file_delivery": q_stream_file_delivery,
    "event_sink_roundtrip": q_event_sink_roundtrip,
    "export_csv": _export("csv"),
    "export_json": _export("json"),
    "export_xml": _export("xml"),
    "export_raw": _export("raw"),
    "event_batches": flagship,
    "batch_assign_big_keys": q_batch_assign_big_keys,
    "batch_assign_string_key": q_batch_assign_string_key,
    "batch_null_events": q_batch_null_events,
    "batch_payload_normalized": q_batch_payload_normalized,
    "batch_payload_hot": q_batch_payload_hot,
    "multi_file_batches": q_multi_file_batches,
    "array_payloads": q_array_payloads,
    "array_events": q_array_events,
    "dead_letters": q_dead_letters,
    "stream_receipts": q_stream_receipts,
    "search_page_large": q_search_page_large,
    "search_empty_result": q_search_empty_result,
    "extract_fields_compat": q_extract_fields_compat,
    "search_raw_mixed": q_search_raw_mixed,
    "event_sink_hot": q_event_sink_hot,
    "export_documents_csv": _export_documents("csv"),
    "export_documents_json": _export_documents("json"),
    "export_documents_xml": _export_documents("xml"),
}


# ---------------------------------------------------------------- DuckDB oracles

def _ts(c: str = "ts") -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%g') || '+0000'"


def _ts_compat(c: str = "ts") -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.') || cast(cast(strftime({c}, '%g') as integer) as varchar) || '+0000'"


def _field(name: str, expr: str | None = None, escape: bool = False) -> str:
    v = f"coalesce(cast({expr or name} as varchar), 'null')"
    if escape:
        v = f"regexp_replace({v}, '([\\\\\"])', '\\\\\\1', 'g')"
    return f"'|{name}=\"' || {v} || '\"'"


def _event(fields: list[str], ts: str | None = "ts", escape: bool = False) -> str:
    head = [_ts(ts)] if ts else []
    return " || ".join(head + [_field(f, escape=escape) for f in fields])


_EVENTS_RAW = f"(SELECT *, {_event(EVENT_FIELDS)} AS raw FROM events)"


def _lineitem_raw(dest: str) -> str:
    return (f"(SELECT *, {dest} AS sourcetype, {_event(LINEITEM_FIELDS, 'l_shipdate')} AS raw "
            f"FROM lineitem)")


def _batched(src: str, part: str, order: str, block: int) -> str:
    part_by = f"PARTITION BY {part} " if part else ""
    return (f"(SELECT *, CAST(floor((sum(octet_length(encode(raw)) + 1) OVER ({part_by}ORDER BY {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1) / {block}) AS BIGINT) AS batch_id FROM {src})")


def _payloads(src: str, part: str, order: str, block: int) -> str:
    keys = f"{part}, " if part else ""
    return (f"(SELECT {keys}batch_id, count(*)::BIGINT AS n_events, "
            f"sum(octet_length(encode(raw)) + 1)::BIGINT AS n_bytes, "
            f"string_agg(raw || chr(10), '' ORDER BY {order}) AS payload "
            f"FROM {_batched(src, part, order, block)} GROUP BY ALL)")


LI_ORDER_SQL = ", ".join(LINEITEM_ORDER)
_LINES = r"'\r\n|\n|\r'"
_FINAL = r"'(\r\n|\n|\r)\z'"


def _split_lines(expr: str) -> str:
    return (f"CASE WHEN {expr} = '' THEN []::VARCHAR[] "
            f"ELSE string_split_regex(regexp_replace({expr}, {_FINAL}, ''), {_LINES}) END")


_WEEK_SEARCH = ("(SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-09 00:00:00' "
                "AND ts < TIMESTAMP '2024-01-16 00:00:00' AND event_type = 'error' AND value > 100)")

ORACLES: dict[str, str] = {
    "event_timestamp": f"SELECT event_id, {_ts()} AS ts_text FROM events",
    "event_timestamp_compat": f"SELECT event_id, {_ts_compat()} AS ts_text FROM events",
    "format_event_fields": f"SELECT event_id, raw FROM {_EVENTS_RAW}",
    "format_event_map": (
        f"SELECT event_id, {_ts()} || coalesce(array_to_string(list_transform(json_keys(props), "
        "lambda k: '|' || k || '=\"' || coalesce(json_extract_string(props, '$.\"' || k || '\"'), 'null') || '\"'), ''), '')"
        " AS raw FROM events"
    ),
    "format_event_default": f"SELECT event_id, raw FROM {_EVENTS_RAW}",
    "event_metadata": (
        "SELECT event_id, \"index\", source, sourcetype, "
        "CASE WHEN concat_ws('&', 'source=' || nullif(source, ''), 'sourcetype=' || nullif(sourcetype, ''), "
        "'index=' || nullif(\"index\", '')) = '' THEN '' ELSE '?' || concat_ws('&', 'source=' || nullif(source, ''), "
        "'sourcetype=' || nullif(sourcetype, ''), 'index=' || nullif(\"index\", '')) END AS query_string "
        "FROM (SELECT event_id, 'main' AS \"index\", 'events' AS source, "
        "coalesce(nullif(nullif(event_type, 'view'), ''), 'generic') AS sourcetype FROM events)"
    ),
    "batch_assign": (
        "SELECT " + LI_ORDER_SQL + ", sourcetype, batch_id FROM "
        + _batched(_lineitem_raw("l_returnflag"), "sourcetype", LI_ORDER_SQL, BLOCK_SIZE)
    ),
    "batch_assign_hot": (
        "SELECT " + LI_ORDER_SQL + ", sourcetype, batch_id FROM "
        + _batched(_lineitem_raw("l_returnflag"), "sourcetype", LI_ORDER_SQL, BLOCK_SIZE)
    ),
    "batch_payload": "SELECT * FROM " + _payloads(_lineitem_raw("l_linestatus"), "sourcetype",
                                                  LI_ORDER_SQL, BLOCK_SIZE),
    "oversize_batches": (
        "SELECT batch_id, n_events, n_bytes, n_bytes > " + str(SMALL_LIMIT) + " AS rejected FROM "
        + _payloads(f"(SELECT *, {_event(DOC_FIELDS, None)} AS raw FROM documents)", "", "doc_id", SMALL_BLOCK)
    ),
    "ship_totals": (
        "SELECT sourcetype, sum(n_bytes)::BIGINT AS read_bytes, "
        f"coalesce(sum(n_bytes) FILTER (WHERE n_bytes <= {MAX_PAYLOAD}), 0)::BIGINT AS sent_bytes, "
        f"count(*) FILTER (WHERE n_bytes <= {MAX_PAYLOAD}) AS calls, "
        f"count(*) FILTER (WHERE n_bytes > {MAX_PAYLOAD}) AS rejected, sum(n_events)::BIGINT AS n_events FROM "
        + _payloads(_lineitem_raw("l_linestatus"), "sourcetype", LI_ORDER_SQL, BLOCK_SIZE)
        + " GROUP BY sourcetype"
    ),
    "read_event_file": (
        "SELECT line_no, batch_id, raw FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS line_no FROM "
        + _batched(_EVENTS_RAW, "", "event_id", BLOCK_SIZE) + ")"
    ),
    "format_event_escaped": f"SELECT doc_id, {_event(DOC_FIELDS, None, escape=True)} AS raw FROM documents",
    "file_receipts": (
        "SELECT batch_id, n_events, n_bytes, md5(payload) AS status FROM "
        + _payloads(_EVENTS_RAW, "", "event_id", BLOCK_SIZE)
    ),
    "event_lines_from_text": (
        "SELECT doc_id, unnest(range(0, len(l))) AS line_no, unnest(l) AS line FROM "
        f"(SELECT doc_id, {_split_lines('text')} AS l FROM documents)"
    ),
    "text_payloads": (
        "SELECT doc_id, len(l)::BIGINT AS n_events, octet_length(encode(p))::BIGINT AS n_bytes, p AS payload, "
        f"octet_length(encode(p)) > {SMALL_LIMIT} AS rejected FROM (SELECT doc_id, l, CASE WHEN len(l) = 0 THEN '' "
        "ELSE array_to_string(l, chr(10)) || chr(10) END AS p FROM "
        f"(SELECT doc_id, {_split_lines('text')} AS l FROM documents))"
    ),
    "event_array_payload": "SELECT * FROM " + _payloads(
        "(SELECT conv_id, turn, text AS raw FROM conversations)", "conv_id", "turn", MAX_PAYLOAD),
    "normalize_lines": (
        "SELECT doc_id, unnest(range(0, len(l))) AS line_no, unnest(l) || chr(10) AS line FROM "
        f"(SELECT doc_id, {_split_lines('raw')} AS l FROM "
        f"(SELECT doc_id, {_event(['doc_id', 'lang', 'text'], None)} AS raw FROM documents))"
    ),
    "search_time_range": ("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' "
                          "AND ts < TIMESTAMP '2024-01-16 00:00:00'"),
    "search_predicate": "SELECT * FROM " + _WEEK_SEARCH,
    "search_stats": (
        "SELECT count(*) AS scan_count, count(*) FILTER (WHERE event_type = 'error' AND value > 100) AS event_count, "
        f"least(greatest(count(*) FILTER (WHERE event_type = 'error' AND value > 100) - {PAGE_OFFSET}, 0), "
        f"{PAGE_COUNT}) AS result_count FROM events WHERE ts >= TIMESTAMP '2024-01-09 00:00:00' "
        "AND ts < TIMESTAMP '2024-01-16 00:00:00'"
    ),
    "search_page": f"SELECT * FROM {_WEEK_SEARCH} ORDER BY ts, event_id LIMIT {PAGE_COUNT} OFFSET {PAGE_OFFSET}",
    "dequote_output": (
        "SELECT event_id, pos - 1 AS pos, split_part(tok, '=', 1) AS field, "
        "regexp_replace(substr(tok, instr(tok, '=') + 1), '(?s)^\"(.*)\"\\z', '\\1') AS value FROM "
        "(SELECT event_id, unnest(range(1, len(t))) AS pos, unnest(t[2:]) AS tok FROM "
        f"(SELECT event_id, string_split(raw, '|') AS t FROM {_EVENTS_RAW}))"
    ),
    "extract_fields": (
        "SELECT date_trunc('millisecond', ts) AS _time, " + ", ".join(
            f"cast({f} as varchar) AS {f}" for f in EVENT_FIELDS) + " FROM events"
    ),
    "extract_fields_escaped": "SELECT " + ", ".join(f"cast({f} as varchar) AS {f}" for f in DOC_FIELDS)
    + " FROM documents",
    "search_raw_events": (
        "SELECT cast(event_id AS VARCHAR) AS event_id, event_type, cast(value AS VARCHAR) AS value, props FROM "
        + _WEEK_SEARCH
    ),
    "delivery_receipts": (
        "SELECT sourcetype, batch_id, n_events, n_bytes, "
        "sha256(concat_ws(chr(31), 'lineitem', '', '', sourcetype, cast(batch_id AS VARCHAR), payload)) AS batch_key, "
        "md5(payload) AS status FROM "
        + _payloads(_lineitem_raw("l_linestatus"), "sourcetype", LI_ORDER_SQL, BLOCK_SIZE)
    ),
    "stream_delivery": f"SELECT raw FROM {_EVENTS_RAW}",
    "stream_file_delivery": "SELECT batch_id, raw FROM " + _batched(_EVENTS_RAW, "", "event_id", BLOCK_SIZE),
    "event_sink_roundtrip": f"SELECT 'main' AS \"index\", event_type AS sourcetype, raw FROM {_EVENTS_RAW}",
    "export_csv": "SELECT * FROM events",
    "export_json": "SELECT * FROM events",
    "export_xml": "SELECT * FROM events",
    "export_raw": f"SELECT raw FROM {_EVENTS_RAW}",
    "export_documents_csv": "SELECT * FROM documents",
    "export_documents_json": "SELECT * FROM documents",
    "export_documents_xml": "SELECT * FROM documents",
    "batch_assign_big_keys": (
        f"SELECT l_orderkey + {BIG} AS big_key, " + ", ".join(LINEITEM_ORDER[1:]) + ", sourcetype, batch_id FROM "
        + _batched(_lineitem_raw("l_returnflag"), "sourcetype", LI_ORDER_SQL, BLOCK_SIZE)
    ),
    "batch_assign_string_key": (
        "SELECT 'orders/line-' || lpad(cast(l_orderkey AS VARCHAR), 12, '0') || "
        + " || ".join(f"lpad(cast({c} AS VARCHAR), 9, '0')" for c in LINEITEM_ORDER[1:])
        + " AS text_key, sourcetype, batch_id FROM "
        + _batched(_lineitem_raw("l_returnflag"), "sourcetype", LI_ORDER_SQL, BLOCK_SIZE)
    ),
    "batch_null_events": "SELECT * FROM " + _payloads(
        "(SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 3 <> 0 THEN text ELSE 'null' END AS raw FROM conversations)",
        "conv_id", "turn", SMALL_BLOCK),
    "batch_payload_normalized": "SELECT * FROM " + _payloads(
        "(SELECT doc_id, text AS raw FROM documents)", "", "doc_id", BLOCK_SIZE),
    "batch_payload_hot": "SELECT * FROM " + _payloads(_lineitem_raw("l_linestatus"), "sourcetype",
                                                      LI_ORDER_SQL, BLOCK_SIZE),
    "multi_file_batches": (
        "SELECT event_type, batch_id, n_events, n_bytes, md5(payload) AS payload_md5 FROM "
        + _payloads(_EVENTS_RAW, "event_type", "event_id", BLOCK_SIZE)
    ),
    "array_payloads": "SELECT doc_id, text || chr(10) AS payload FROM documents",
    "array_events": (
        "SELECT doc_id, unnest(range(0, len(l))) AS pos, unnest(l) AS raw FROM "
        "(SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)"
    ),
    "dead_letters": (
        f"SELECT batch_id, n_events, n_bytes, payload AS dead_letter FROM "
        + _payloads(f"(SELECT *, {_event(DOC_FIELDS, None)} AS raw FROM documents)", "", "doc_id", SMALL_BLOCK)
        + f" WHERE n_bytes > {SMALL_LIMIT}"
    ),
    "stream_receipts": (
        "SELECT unnest([0, 1])::BIGINT AS stream_batch_id, batch_id, n_events, n_bytes, md5(payload) AS status, "
        "2::BIGINT AS n_keys FROM " + _payloads(_EVENTS_RAW, "", "event_id", BLOCK_SIZE)
    ),
    "search_page_large": (
        "SELECT * FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS row_no FROM events) "
        f"WHERE row_no > {LARGE_OFFSET} AND row_no <= {LARGE_OFFSET + LARGE_COUNT}"
    ),
    "search_empty_result": (
        "SELECT count(*) AS scan_count, 0::BIGINT AS event_count, 0::BIGINT AS result_count, false AS written FROM events "
        "WHERE ts >= TIMESTAMP '2024-01-09 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'"
    ),
    "extract_fields_compat": (
        "SELECT date_trunc('millisecond', ts) AS _time, " + ", ".join(
            f"cast({f} as varchar) AS {f}" for f in EVENT_FIELDS) + " FROM events"
    ),
    "search_raw_mixed": (
        "SELECT cast(event_id AS VARCHAR) AS event_id, event_type, date_trunc('millisecond', ts) AS _time FROM events "
        "UNION ALL SELECT NULL, NULL, NULL FROM events WHERE event_id % 7 = 0"
    ),
    "event_sink_hot": ("SELECT 'main' AS \"index\", 'hot' AS sourcetype, 'the same line' AS raw, count(*) AS n "
                       "FROM lineitem"),
    "event_batches": (
        "SELECT \"index\", source, sourcetype, batch_id, n_events, n_bytes, md5(payload) AS payload_md5 FROM "
        + _payloads(
            f"(SELECT *, 'main' AS \"index\", 'events' AS source, "
            f"coalesce(nullif(nullif(event_type, 'view'), ''), 'generic') AS sourcetype, {_event(EVENT_FIELDS)} AS raw "
            "FROM events)", "\"index\", source, sourcetype", "event_id", BLOCK_SIZE)
    ),
}
