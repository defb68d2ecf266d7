"""Shipping events as they arrive: Structured Streaming + ``foreachBatch``.

Each micro-batch is formatted, batched and delivered like a batch job. Batch ids
restart at 0 in every micro-batch, so receipts are keyed by
``(stream_batch_id, batch_id)``, and each micro-batch is a shipment of its own
(``<shipment>/<stream_batch_id>``) in ``batch_key``, the same when it is replayed. A micro-batch can be replayed after a failure;
its receipts and payloads are written to a folder named after the micro-batch id
with ``overwrite``, so a replay replaces instead of duplicating. Stateless: no
watermark or state store is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventloom.operators.batching import BLOCK_SIZE, MAX_PAYLOAD, batch_events
from eventloom.operators.prefix import DEFAULT_SPLIT_ROWS
from eventloom.plans.ship import batch_file_lines
from eventloom.sinks.deliver import Sender, deliver, md5_sender
from eventloom.sinks.retry import Retry


def read_event_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                      glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream (new files in ``path`` become new micro-batches)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def read_event_file_stream(spark: SparkSession, path: str, glob: str | None = None,
                           max_files_per_trigger: int | None = None, value: str = "raw") -> DataFrame:
    """New text files in ``path`` as a stream of event lines with their file split
    (``file_path``, ``file_block_start``); pass ``file_lines=True`` to
    :func:`start_delivery`, which adds the in-split line key per micro-batch."""
    reader = spark.readStream.format("text")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
        F.col("value").alias(value),
    )


def start_delivery(
    events: DataFrame,
    order: Sequence[str],
    out_path: str,
    checkpoint: str,
    send: Sender = md5_sender,
    block_size: int = BLOCK_SIZE,
    limit: int = MAX_PAYLOAD,
    destination: Sequence[str] | None = None,
    keep_payloads: bool = False,
    available_now: bool = True,
    processing_time: str | None = None,
    raw: Column | str = "raw",
    size: Column | None = None,
    file_lines: bool = False,
    split_rows: int | None = DEFAULT_SPLIT_ROWS,
    shipment: str | None = None,
    send_order: str = "none",
    per_file: bool = True,
    retry: Retry | None = None,
) -> StreamingQuery:
    """Start the stream. ``raw`` is the event text: a column of ``events`` (see
    ``format_events``) or an expression over its columns (see ``event_text``,
    with ``size`` from ``event_size``), which is then built only after the
    batching shuffle, as in :func:`eventloom.plans.ship.table_batches`.
    With ``file_lines`` (a stream from :func:`read_event_file_stream`), lines are
    batched in file order, each file on its own unless ``per_file=False``, and ``order``
    is ignored. ``split_rows=None`` skips the
    per-micro-batch count of rows per destination when micro-batches are known to
    be small (e.g. bounded by ``maxFilesPerTrigger``). ``shipment`` names the stream in
    ``batch_key`` (default: its checkpoint folder) and ``send_order`` is delivery's ``order``.

    Each micro-batch is one delivery job writing ``ledger/stream_batch_id=N`` below
    ``out_path`` (receipts of sent batches and dead letters of rejected ones, see
    :func:`read_stream_receipts`), plus ``payloads/...`` when ``keep_payloads``. Its totals are observed
    in that job (:func:`stream_totals`). ``retry`` says what was sent and how often to try.
    """
    order = list(order)

    def run(batch_df: DataFrame, epoch_id: int) -> None:
        if file_lines:
            lines = batch_df.withColumn("line_key", F.monotonically_increasing_id())
            payloads = batch_file_lines(lines, block_size, destination, per_file, raw=raw, size=size)
        else:
            payloads = batch_events(batch_df, order, block_size, raw=raw, destination=destination, size=size,
                                    split_rows=split_rows)
        if keep_payloads:
            payloads = payloads.checkpoint(eager=True)  # the same batches for both outputs
            payloads.write.mode("overwrite").parquet(f"{out_path}/payloads/stream_batch_id={epoch_id}")
        tag = F.lit(epoch_id).cast("long").alias("stream_batch_id")
        key = f"{shipment or checkpoint}/{epoch_id}"
        ledger = deliver(payloads, send, destination, limit=limit, order=send_order, shipment=key, retry=retry).select(tag, "*")
        # counted while the ledger is written: no second pass
        seen = Observation(f"totals-{epoch_id}")
        ledger = ledger.observe(seen, *_observed(ledger))
        ledger.write.mode("overwrite").parquet(f"{out_path}/ledger/stream_batch_id={epoch_id}")
        counts = seen.get
        batch_df.sparkSession.createDataFrame([tuple(int(counts[c] or 0) for c in TOTALS)], ", ".join(f"{c} long" for c in TOTALS)).coalesce(1) \
            .write.mode("overwrite").parquet(f"{out_path}/totals/stream_batch_id={epoch_id}")

    writer = events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


#: Totals of a micro-batch.
TOTALS = ("read_bytes", "sent_bytes", "batches", "rejected", "n_events")


def _observed(ledger: DataFrame) -> list[Column]:
    sent = ~F.col("rejected")
    return [F.sum("n_bytes").alias("read_bytes"), F.sum(F.when(sent, F.col("n_bytes"))).alias("sent_bytes"), F.count_if(sent).alias("batches"),
            F.count_if(~sent).alias("rejected"), F.sum("n_events").alias("n_events")]


def stream_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """Totals of each finished micro-batch of a running or ended stream: one small row each, however much was shipped."""
    return spark.read.option("basePath", f"{out_path}/totals").parquet(f"{out_path}/totals").select(
        F.col("stream_batch_id").cast("long").alias("stream_batch_id"), *TOTALS)


def read_stream_receipts(spark: SparkSession, out_path: str, rejected: bool = False) -> DataFrame:
    """Receipts of sent batches (or, with ``rejected=True``, the dead letters)."""
    ledger = spark.read.parquet(f"{out_path}/ledger")
    if rejected:
        return ledger.where(F.col("rejected")).drop("status")
    return ledger.where(~F.col("rejected")).drop("rejected", "dead_letter")
