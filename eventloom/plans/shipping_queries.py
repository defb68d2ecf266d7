"""Registered queries of shipments that answer, resume, continue and read in place, with their DuckDB oracles."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventloom.functions.fields import event_size, event_text
from eventloom.operators.batching import assign_batches, batch_events, oversize, repack_oversize
from eventloom.operators.format import format_events, with_destination
from eventloom.plans.catalog import (
    _EVENTS_RAW,
    DOC_FIELDS,
    EVENT_FIELDS,
    LI_ORDER_SQL,
    LINEITEM_FIELDS,
    LINEITEM_ORDER,
    SMALL_BLOCK,
    SMALL_LIMIT,
    STREAM_FILES,
    Query,
    _batched,
    _event,
    _events,
    _formatted_events,
    _lineitem_raw,
    _lineitem_routed,
    _payloads,
)
from eventloom.plans.files import ship_files
from eventloom.plans.ship import ship, ship_resumable, table_batches
from eventloom.session import scratch_path
from eventloom.sinks.deliver import md5_sender
from eventloom.sinks.retry import Retry, redelivery_queue
from eventloom.sources.tables import read_table
from eventloom.streaming.continued import finish_delivery, start_continued_delivery
from eventloom.streaming.delivery import read_event_stream, read_stream_receipts

# Blocks small enough that every table size has many.
SHIP_BLOCK = 32_768
WIDE_BYTES = 100_000
TRY = Retry(attempts=4, wait=0.001)


def _document_batches(spark, sf):
    docs = format_events(read_table(spark, sf, "documents"), DOC_FIELDS, ts=False)
    return batch_events(docs, ["doc_id"], SMALL_BLOCK, destination=[])


def q_oversize_repacked(spark, sf):
    """Batches over the limit cut on line ends; what is still over it is one line alone."""
    parts = repack_oversize(_document_batches(spark, sf), SMALL_LIMIT)
    return parts.select("batch_id", F.col("part").cast("long").alias("part"), "n_events", "n_bytes", F.md5("payload").alias("payload_md5"),
                        oversize(parts, SMALL_LIMIT).alias("rejected"))


def q_batch_assign_wide_rows(spark, sf):
    """Documents for one destination: too few rows to be cut by their number, cut by their bytes."""
    docs = with_destination(format_events(read_table(spark, sf, "documents"), DOC_FIELDS, ts=False), index="main")
    assigned = assign_batches(docs, ["doc_id"], SMALL_BLOCK, destination=["index"], split_bytes=WIDE_BYTES)
    return assigned.select("doc_id", "batch_id")


def _small_lineitem_batches(spark, sf):
    return table_batches(_lineitem_routed(spark, sf, "l_linestatus"), LINEITEM_ORDER, LINEITEM_FIELDS, "l_shipdate", block_size=SHIP_BLOCK)


def _failing_sender(payload: str, destination: dict) -> str:
    status = md5_sender(payload, destination)
    if status.startswith("0"):
        raise ConnectionError("the receiver is gone")
    return status


def q_ship_resumed(spark, sf):
    """A shipment whose first run fails midway, and its second run over the same log."""
    log = scratch_path(spark, "attempt-log")
    payloads = _small_lineitem_batches(spark, sf)
    anything = Retry(attempts=1, outcome=lambda status: "sent")
    try:
        # the first run gives up on a batch, as a receiver that goes away makes it
        ship_resumable(payloads, "lineitem", log, _failing_sender, retry=None)
    except PySparkException:
        pass
    receipts, _, _ = ship_resumable(payloads, "lineitem", log, retry=anything)
    n = receipts.groupBy("batch_key").agg(F.count("*").alias("n_receipts"))
    return receipts.join(n, "batch_key").select("sourcetype", "batch_id", "n_events", "n_bytes", "batch_key", "status", "n_receipts")


def _moody_sender():
    """Answers by the payload: most are taken; some never, some not at first."""
    tries: dict[str, int] = {}

    def send(payload: str, destination: dict) -> str:
        h = md5_sender(payload, destination)
        tries[h] = tries.get(h, 0) + 1
        if h[0] == "0":
            return "400 Bad Request"
        if h[0] == "3" or h[0] in "12" and tries[h] < 3:
            return "503 Service Unavailable"
        return "200 OK"

    return send


def q_ship_outcomes(spark, sf):
    """Totals by what the receiver answered."""
    _, _, totals = ship(_small_lineitem_batches(spark, sf), _moody_sender(), retry=TRY)
    return totals.select("sourcetype", "read_bytes", "sent_bytes", "calls", "rejected", "n_events", "refused", "retried")


def q_ship_redelivered(spark, sf):
    """What a receiver refused, shipped again to one that takes it."""
    _, rejected, _ = ship(_small_lineitem_batches(spark, sf), _moody_sender(), retry=TRY)
    receipts, _, _ = ship(redelivery_queue(rejected))
    return receipts.select("sourcetype", "batch_id", "n_events", "n_bytes", "status")


def q_stream_continued_batches(spark, sf):
    """A stream of several micro-batches: blocks as if it were one file."""
    src, out, ckpt = (scratch_path(spark, n) for n in ("stream-continued", "stream-out", "stream-ckpt"))
    ev = with_destination(_events(spark, sf), index="main", sourcetype=F.col("event_type"))
    most = ev.agg(F.max("event_id")).first()[0] + 1
    for k in range(STREAM_FILES):  # files come one after the other
        ev.where((F.col("event_id") * STREAM_FILES >= k * most) & (F.col("event_id") * STREAM_FILES < (k + 1) * most)).coalesce(1).write.mode("append").parquet(src)
    stream = read_event_stream(spark, src, ev.schema, glob="*.parquet", max_files_per_trigger=1)
    start_continued_delivery(stream, ["event_id"], out, ckpt, block_size=SHIP_BLOCK, destination=["sourcetype"],
                             raw=event_text(EVENT_FIELDS, "ts"), size=event_size(EVENT_FIELDS, "ts")).awaitTermination()
    finish_delivery(spark, out, ckpt)
    return read_stream_receipts(spark, out).select("sourcetype", "batch_id", "n_events", "n_bytes", "status")


def q_file_batches_streamed(spark, sf):
    """Event files shipped from the tasks that read them, as parts of one file."""
    path = scratch_path(spark, "event-file")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _formatted_events(spark, sf).repartitionByRange(n, "event_id").sortWithinPartitions("event_id").select("raw").write.text(path)
    receipts, _, _ = ship_files(spark, path, block_size=SHIP_BLOCK, per_file=False)
    return receipts.select("batch_id", "n_events", "n_bytes", "status")


QUERIES: dict[str, Query] = {
    "oversize_repacked": q_oversize_repacked,
    "batch_assign_wide_rows": q_batch_assign_wide_rows,
    "ship_resumed": q_ship_resumed,
    "ship_outcomes": q_ship_outcomes,
    "ship_redelivered": q_ship_redelivered,
    "stream_continued_batches": q_stream_continued_batches,
    "file_batches_streamed": q_file_batches_streamed,
}

# ---------------------------------------------------------------- DuckDB oracles

_DOC_BATCHES = _payloads(f"(SELECT *, {_event(DOC_FIELDS, None)} AS raw FROM documents)", "", "doc_id", SMALL_BLOCK)
_LI_BATCHES = _payloads(_lineitem_raw("l_linestatus"), "sourcetype", LI_ORDER_SQL, SHIP_BLOCK)
_ANSWERED = f"(SELECT *, md5(payload) AS h, md5(payload)[1] AS c FROM {_LI_BATCHES})"

ORACLES: dict[str, str] = {
    "oversize_repacked": f"""
WITH RECURSIVE p AS MATERIALIZED (SELECT * FROM {_DOC_BATCHES}),
u AS (
  SELECT batch_id, unnest(string_split(payload[:-2], chr(10))) AS line, generate_subscripts(string_split(payload[:-2], chr(10)), 1) AS pos
  FROM p WHERE n_bytes > {SMALL_LIMIT}),
s AS (SELECT *, octet_length(encode(line)) + 1 AS size FROM u),
l AS MATERIALIZED (SELECT *, sum(size) OVER (PARTITION BY batch_id ORDER BY pos) AS upto FROM s),
next AS MATERIALIZED (
  SELECT a.batch_id, a.pos, min(b.pos) AS follows FROM l a JOIN l b
  ON a.batch_id = b.batch_id AND b.pos > a.pos AND b.upto - a.upto + a.size > {SMALL_LIMIT} GROUP BY ALL),
r AS (
  SELECT batch_id, 0 AS part, 1::BIGINT AS pos FROM p WHERE n_bytes > {SMALL_LIMIT}
  UNION ALL SELECT r.batch_id, r.part + 1, n.follows FROM r JOIN next n ON r.batch_id = n.batch_id AND r.pos = n.pos),
cut AS (
  SELECT r.batch_id, r.part::BIGINT AS part, count(*) AS n_events, sum(l.size)::BIGINT AS n_bytes,
    md5(string_agg(l.line || chr(10), '' ORDER BY l.pos)) AS payload_md5
  FROM r LEFT JOIN next n ON r.batch_id = n.batch_id AND r.pos = n.pos
  JOIN l ON l.batch_id = r.batch_id AND l.pos >= r.pos AND (n.follows IS NULL OR l.pos < n.follows) GROUP BY r.batch_id, r.part)
SELECT batch_id, 0::BIGINT AS part, n_events, n_bytes, md5(payload) AS payload_md5, false AS rejected FROM p WHERE n_bytes <= {SMALL_LIMIT}
UNION ALL SELECT *, n_bytes > {SMALL_LIMIT} FROM cut""",
    "batch_assign_wide_rows": "SELECT doc_id, batch_id FROM "
    + _batched(f"(SELECT *, {_event(DOC_FIELDS, None)} AS raw FROM documents)", "", "doc_id", SMALL_BLOCK),
    "ship_resumed": (
        "SELECT sourcetype, batch_id, n_events, n_bytes, "
        "sha256(concat_ws(chr(31), 'lineitem', '', '', sourcetype, cast(batch_id AS VARCHAR), payload)) AS batch_key, "
        f"md5(payload) AS status, 1::BIGINT AS n_receipts FROM {_LI_BATCHES}"
    ),
    "ship_outcomes": (
        "SELECT sourcetype, sum(n_bytes)::BIGINT AS read_bytes, coalesce(sum(n_bytes) FILTER (WHERE c NOT IN ('0', '3')), 0)::BIGINT AS sent_bytes, "
        "sum(CASE WHEN c IN ('1', '2') THEN 3 WHEN c = '3' THEN 4 ELSE 1 END)::BIGINT AS calls, 0::BIGINT AS rejected, sum(n_events)::BIGINT AS n_events, "
        f"count(*) FILTER (WHERE c IN ('0', '3')) AS refused, count(*) FILTER (WHERE c IN ('1', '2')) AS retried FROM {_ANSWERED} GROUP BY sourcetype"
    ),
    "ship_redelivered": f"SELECT sourcetype, batch_id, n_events, n_bytes, h AS status FROM {_ANSWERED} WHERE c IN ('0', '3')",
    "stream_continued_batches": (
        "SELECT sourcetype, batch_id, n_events, n_bytes, md5(payload) AS status FROM "
        + _payloads(f"(SELECT *, event_type AS sourcetype FROM {_EVENTS_RAW})", "sourcetype", "event_id", SHIP_BLOCK)
    ),
    "file_batches_streamed": f"SELECT batch_id, n_events, n_bytes, md5(payload) AS status FROM {_payloads(_EVENTS_RAW, '', 'event_id', SHIP_BLOCK)}",
}
