"""Streams whose blocks continue from one micro-batch to the next.

A destination's batch ids run over the whole stream, as if all of it were one file: the last
block of a micro-batch stays open, and the next micro-batch's first events are put behind
it. The state of a destination is the number of bytes in its closed blocks and the open
block (id, events, bytes, text; at most a block and a line). It is a table with one row for each
destination, written below ``out_path`` by micro-batch: micro-batch N reads what N - 1 wrote
and writes its own with ``overwrite``, so a replayed one gives the same again. Batching
itself is the batch job's, so that a destination with most of the events is cut over tasks,
which a state store keyed by destination would not allow.

:func:`finish_delivery` sends the blocks still open once the stream is over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventloom.operators.batching import BLOCK_SIZE, MAX_PAYLOAD, batch_events, present_destination, repack_oversize
from eventloom.operators.prefix import DEFAULT_BROADCAST_ROWS, DEFAULT_SPLIT_ROWS, _null_safe_join
from eventloom.session import checkpoint_root
from eventloom.sinks.deliver import Sender, deliver, md5_sender
from eventloom.sinks.retry import Retry

_BLOCK = ("batch_id", "n_events", "n_bytes", "payload")


def start_continued_delivery(
    events: DataFrame,
    order: Sequence[str],
    out_path: str,
    checkpoint: str,
    send: Sender = md5_sender,
    block_size: int = BLOCK_SIZE,
    limit: int = MAX_PAYLOAD,
    destination: Sequence[str] | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    raw: Column | str = "raw",
    size: Column | None = None,
    split_rows: int | None = DEFAULT_SPLIT_ROWS,
    shipment: str | None = None,
    retry: Retry | None = None,
    repack: bool = False,
) -> StreamingQuery:
    """Start the stream (parameters as in :func:`eventloom.streaming.delivery.start_delivery`). A micro-batch
    sends the blocks that it closes; receipts are read by ``read_stream_receipts``."""
    order = list(order)

    def run(batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        checkpoint_root(spark)
        dest = present_destination(batch_df, destination)
        state = spark.read.parquet(f"{out_path}/state/epoch={epoch_id - 1}") if epoch_id else None
        before = None if state is None else state.select(*dest, (F.col("closed_bytes") + F.col("n_bytes")).alias("_from"))
        blocks = batch_events(batch_df, order, block_size, raw=raw, destination=dest, size=size, split_rows=split_rows, start=before)
        rows = blocks.select(*dest, *_BLOCK, F.lit(1).alias("_turn"), F.lit(0).cast("long").alias("closed_bytes"))
        if state is not None:
            rows = rows.unionByName(state.withColumn("_turn", F.lit(0)))
        # an open block and its continuation are one row; the text is written once, for the sends and the state
        rows = rows.groupBy(*dest, "batch_id").agg(
            F.sum("n_events").alias("n_events"), F.sum("n_bytes").alias("n_bytes"),
            F.expr("listagg(payload, '') WITHIN GROUP (ORDER BY _turn)").alias("payload"), F.max("closed_bytes").alias("closed_bytes"),
        ).checkpoint(eager=True)
        ends = rows.groupBy(*dest).agg(F.max("batch_id").alias("_last"), F.max("closed_bytes").alias("_closed"), F.sum("n_bytes").alias("_bytes"))
        if dest:
            placed = _null_safe_join(rows, ends.checkpoint(eager=True), dest, "inner", DEFAULT_BROADCAST_ROWS)
        else:
            last = ends.first()
            placed = rows.select("*", *[F.lit(last[c]).cast("long").alias(c) for c in ("_last", "_closed", "_bytes")])
        still_open = F.col("batch_id") == F.col("_last")
        _send(placed.where(~still_open).select(*dest, *_BLOCK), out_path, epoch_id, send, dest, limit, f"{shipment or checkpoint}", retry, repack)
        closed = F.col("_closed") + F.col("_bytes") - F.col("n_bytes")
        placed.where(still_open).select(*dest, *_BLOCK, closed.alias("closed_bytes")).write.mode("overwrite").parquet(f"{out_path}/state/epoch={epoch_id}")

    writer = events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _send(payloads: DataFrame, out_path: str, epoch: int, send: Sender, dest: list[str], limit: int, shipment: str,
          retry: Retry | None, repack: bool) -> None:
    batches = repack_oversize(payloads, limit, dest) if repack else payloads
    # ids run over the stream, so the shipment alone tells its batches apart
    ledger = deliver(batches, send, dest, limit=limit, shipment=shipment, retry=retry)
    ledger.select(F.lit(epoch).cast("long").alias("stream_batch_id"), "*").write.mode("overwrite").parquet(f"{out_path}/ledger/stream_batch_id={epoch}")


def finish_delivery(spark: SparkSession, out_path: str, checkpoint: str, send: Sender = md5_sender, limit: int = MAX_PAYLOAD,
                    shipment: str | None = None, retry: Retry | None = None, repack: bool = False) -> None:
    """Send the open blocks of a stream that is over, as micro-batch -1 of its ledger. Nothing to do
    for a stream that never had a micro-batch with events."""
    states = spark.read.option("basePath", f"{out_path}/state").parquet(f"{out_path}/state")
    last = states.agg(F.max("epoch")).first()[0]
    if last is None:
        return
    state = states.where(F.col("epoch") == last).drop("epoch", "closed_bytes")
    dest = [c for c in state.columns if c not in _BLOCK]
    _send(state, out_path, -1, send, dest, limit, f"{shipment or checkpoint}", retry, repack)
