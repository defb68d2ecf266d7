"""End-to-end shipping plans: rows or files -> event text -> batches -> receipts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.fields import DEFAULT_DELIM, FieldSpec, event_size, event_text
from eventloom.operators.batching import BLOCK_SIZE, MAX_PAYLOAD, batch_events, present_destination, repack_oversize, ship_totals
from eventloom.operators.prefix import DEFAULT_SPLIT_ROWS
from eventloom.session import scratch_path
from eventloom.sinks.deliver import Sender, deliver, md5_sender
from eventloom.sinks.resume import read_log, send_logged
from eventloom.sinks.retry import Retry
from eventloom.sources.text import FILE_ORDER, FILE_SEGMENT, read_event_file


def table_batches(
    df: DataFrame,
    order: Sequence[str],
    fields: FieldSpec | None = None,
    ts: str | None | bool = "ts",
    delim: str = DEFAULT_DELIM,
    block_size: int = BLOCK_SIZE,
    escape: str = "none",
    split_rows: int | None = DEFAULT_SPLIT_ROWS,
) -> DataFrame:
    """Format every row as an event and cut the events into payloads, per destination
    (``index``/``source``/``sourcetype`` columns when present, see ``with_destination``).
    ``ts=None`` stamps the send time; ``ts=False`` writes no timestamp.

    The event text is passed on as an expression: it is measured without being
    built (:func:`event_size`) and built only after the shuffle, so the shuffle
    moves source columns instead of text."""
    ts_name = ts if isinstance(ts, str) else None
    fields = fields if fields is not None else [c for c in df.columns if c != ts_name]
    stamp = ts is not False
    raw = event_text(fields, ts if stamp else None, delim, escape, with_timestamp=stamp)
    size = event_size(fields, ts if stamp else None, delim, escape, with_timestamp=stamp, wire=True)
    return batch_events(df, order, block_size, raw=raw, size=size, split_rows=split_rows)


def file_batches(spark: SparkSession, path: str | list[str], block_size: int = BLOCK_SIZE,
                 per_file: bool = True) -> DataFrame:
    """Lines of event files cut into payloads in file order. Each file is batched on its
    own: payloads are keyed by ``file_path``, none holds lines of two files, and the
    windows over split offsets are partitioned by file. ``per_file=False`` takes the
    files of a folder, by path, as the parts of one file."""
    return batch_file_lines(read_event_file(spark, path), block_size, per_file=per_file)


def batch_file_lines(lines: DataFrame, block_size: int = BLOCK_SIZE, destination: Sequence[str] | None = None,
                     per_file: bool = True, **how) -> DataFrame:
    """Payloads of lines that have :data:`FILE_ORDER`, per destination and (by default) file."""
    dest = present_destination(lines, destination)
    if per_file:
        return batch_events(lines, list(FILE_ORDER), block_size, destination=["file_path", *dest],
                            segment=list(FILE_SEGMENT[1:]), **how)
    return batch_events(lines, list(FILE_ORDER), block_size, destination=dest, segment=list(FILE_SEGMENT), **how)


def ship(payloads: DataFrame, send: Sender = md5_sender, limit: int = MAX_PAYLOAD,
         receipts_path: str | None = None, tasks: int | None = None, order: str = "none",
         shipment: str | None = None, retry: Retry | None = None,
         repack: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Deliver every payload up to ``limit`` in one job; return (receipts, rejected, totals).

    The job writes one ledger row per batch (below the shared checkpoint folder by
    default): the receipt of a sent batch, or the text of a rejected one. Receipts,
    dead letters and totals are read from that ledger, so the batching runs once
    and later actions never send again. ``tasks`` fixes the number of concurrent
    sending tasks, ``order`` what order they keep and ``shipment`` the id in their keys
    (see :func:`eventloom.sinks.deliver.deliver`).

    ``repack`` cuts batches over the limit on their line ends, so that only lines which are
    over it alone are rejected. With ``retry`` a status decides what was sent: batches that the
    receiver refused are rejected rows, too, and totals count what it accepted.
    """
    spark = payloads.sparkSession
    path = receipts_path or scratch_path(spark, "ledger")
    batches = repack_oversize(payloads, limit) if repack else payloads
    deliver(batches, send, limit=limit, tasks=tasks, order=order, shipment=shipment, retry=retry).write.mode("overwrite").parquet(path)
    return _from_ledger(spark.read.parquet(path), limit)


def _from_ledger(ledger: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    receipts = ledger.where(~F.col("rejected")).drop("rejected", "dead_letter")
    rejected = ledger.where(F.col("rejected"))
    # a refused batch has an answer, one over the limit was not sent
    return receipts, rejected if "outcome" in ledger.columns else rejected.drop("status"), ship_totals(ledger, limit)


def ship_resumable(payloads: DataFrame, shipment: str, log: str, send: Sender = md5_sender, limit: int = MAX_PAYLOAD,
                   tasks: int | None = None, order: str = "none", retry: Retry | None = None,
                   repack: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As :func:`ship`, with an attempt log in the folder ``log`` that outlives a failed job.

    Call it again with the same shipment, payloads and log: batches that were sent, or are over the
    limit, are left alone; the others, refused ones included, are sent. Each batch has one row in
    what is returned, whatever number of runs it took.
    """
    batches = repack_oversize(payloads, limit) if repack else payloads
    send_logged(batches, shipment, log, send, limit, tasks, order, retry or Retry(attempts=1, outcome=lambda status: "sent"))
    return _from_ledger(read_log(payloads.sparkSession, log, batches), limit)
