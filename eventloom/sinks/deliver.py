"""Delivering payloads: one call per batch on the executors, one receipt per batch.

The transport is a caller-supplied ``send(payload: str, destination: dict) -> str``
that runs on executors (an HTTP client, a message-queue producer, ...). In which order
payloads are sent is the caller's choice, never a result of the data's size:

* ``order='none'``: from the tasks that built them, or re-spread over ``tasks``; no order
  is promised, and one destination is sent by many tasks at once;
* ``order='destination'``: each destination's batches one after the other by batch id,
  as a sequential shipper sends a file; a destination is one task's work.

Task retries and speculative tasks can call ``send`` again for a batch, so
delivery is at-least-once. Every receipt carries ``batch_key``, a SHA-256 of the
shipment, destination, batch id and payload, that a receiver can use to drop repeats.
The shipment id keeps equal batches of different shipments apart; it is fixed when
the plan is made, so a retried task writes the same keys.
Every action on the returned frame sends again: write the receipts once and
read them back (:func:`eventloom.plans.ship.ship`, or :func:`deliver_once`); a shipment that
must survive a failed job keeps an attempt log (:mod:`eventloom.sinks.resume`).
With a :class:`eventloom.sinks.retry.Retry` the status decides whether a batch was sent.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.batching import batch_keys
from eventloom.session import scratch_path
from eventloom.sinks.retry import Retry

Sender = Callable[[str, dict], str]

def md5_sender(payload: str, destination: dict) -> str:
    """A sender stub for tests: the 'status' is the MD5 of the payload's UTF-8 bytes."""
    return hashlib.md5(payload.encode("utf-8")).hexdigest()


def plain(v):
    """A destination value as a plain Python value (numpy scalars unwrapped, NaN/NA as None)."""
    if v is None or (not isinstance(v, str) and pd.isna(v)):
        return None
    return v.item() if hasattr(v, "item") else v


#: Bytes of rows that are Python objects at once, where a task sends from Arrow batches.
SLICE_BYTES = 4 * 1024 * 1024


def row_slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches, about ``most`` bytes at a time."""
    for batch in batches:
        rows = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch  # not held while the next one is read


def plain_values(values: pa.Array) -> list:
    """:func:`plain` values of a column; times as wall-clock times of the session's zone."""
    if pa.types.is_timestamp(values.type) and values.type.tz:
        values = pc.local_timestamp(values)
    return [plain(v) for v in values.to_pylist()]


def keyed_batches(payloads: DataFrame, shipment: str, destination: Sequence[str] | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Payload rows with their ``batch_key`` (and ``part``, where batches were repacked); ``keep`` names other columns to carry."""
    dest = batch_keys(payloads, destination)
    part = [c for c in ("part",) if c in payloads.columns]
    number = [F.col("batch_id").cast("string")]
    if part:  # part 0 of a batch has the batch's own key
        number = [F.when(F.col("part") == 0, number[0]).otherwise(F.concat_ws(".", number[0], F.col("part").cast("string")))]
    return payloads.select(
        *dest, *keep, "batch_id", *part, "n_events", "n_bytes", "payload",
        F.sha2(F.concat_ws("\u001f", F.lit(shipment), *[F.coalesce(F.col(d).cast("string"), F.lit("")) for d in dest],
                           *number, F.col("payload")), 256).alias("batch_key"),
    )


def spread(keyed: DataFrame, dest: Sequence[str], tasks: int | None, order: str) -> DataFrame:
    """Keyed batches on the tasks that send them, in sending order."""
    if order not in ("none", "destination"):
        raise ValueError(f"order must be 'none' or 'destination', got {order!r}")
    if order == "destination":
        # a constant first: payloads without a destination are one destination
        keyed = keyed.repartition(*([tasks] if tasks else []), F.lit(0), *dest)
    elif tasks:
        keyed = keyed.repartition(tasks, *dest, "batch_id")
    return keyed.sortWithinPartitions(*dest, "batch_id", *[c for c in ("part",) if c in keyed.columns])


def ledger_columns(keyed: DataFrame, dest: Sequence[str], limit: int | None, retry: Retry | None) -> dict[str, str]:
    """Names and types of the rows that sending gives."""
    types = dict(keyed.dtypes)
    cols = [*dest, "batch_id", *[c for c in ("part",) if c in types], "n_events", "n_bytes", "batch_key"]
    out = {c: types[c] for c in cols} | {"status": "string"}
    if retry is not None:
        out |= {"attempts": "int", "outcome": "string"}
    if limit is not None or retry is not None:
        out |= {"rejected": "boolean", "dead_letter": "string"}
    return out


def deliver(payloads: DataFrame, send: Sender = md5_sender, destination: Sequence[str] | None = None,
            limit: int | None = None, tasks: int | None = None, order: str = "none",
            shipment: str | None = None, retry: Retry | None = None) -> DataFrame:
    """Receipts: destination, ``batch_id, n_events, n_bytes, batch_key, status``.

    ``tasks`` fixes how many tasks send at once (hash-spread by destination and batch, or
    by destination alone with ``order='destination'``); by default the payloads' own
    partitioning, or Spark's shuffle partitions. ``shipment`` names what is sent (a file,
    a run) in ``batch_key``; each call without one is a shipment of its own.

    With ``limit``, a batch larger than ``limit`` is not sent: its row comes back
    with ``status`` null, ``rejected = true`` and its text in ``dead_letter`` (null
    for sent batches), so one job yields receipts and dead letters together.

    With ``retry``, rows also have ``attempts`` and ``outcome``: ``sent``, ``refused`` (also
    rejected, with its text) or ``oversize``. Without it any status is a receipt.
    """
    dest = batch_keys(payloads, destination)
    keyed = keyed_batches(payloads, uuid.uuid4().hex if shipment is None else shipment, dest)
    columns = ledger_columns(keyed, dest, limit, retry)

    def run(frames):
        for pdf in frames:
            rows = [send_row(send, retry, limit, n, text, {d: plain(pdf[d].iat[i]) for d in dest})
                    for i, (n, text) in enumerate(zip(pdf["n_bytes"].tolist(), pdf["payload"].tolist()))]
            res = pdf.drop(columns=["payload"])
            for k, c in enumerate(("status", "attempts", "outcome", "rejected", "dead_letter")):
                if c in columns:
                    kind = {"attempts": "int32", "rejected": "bool"}.get(c, "object")
                    res[c] = pd.Series([r[k] for r in rows], index=pdf.index, dtype=kind)
            yield res[list(columns)]

    return spread(keyed, dest, tasks, order).mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in columns.items()))


def send_row(send: Sender, retry: Retry | None, limit: int | None, size: int, payload: str,
             destination: dict) -> tuple[str | None, int, str, bool, str | None]:
    """(status, attempts, outcome, rejected, dead_letter) of one batch."""
    if limit is not None and size > limit:
        return None, 0, "oversize", True, payload
    if retry is None:
        return send(payload, destination), 1, "sent", False, None
    status, attempts, outcome = retry.send(send, payload, destination)
    return status, attempts, outcome, outcome != "sent", payload if outcome != "sent" else None


def deliver_once(payloads: DataFrame, send: Sender = md5_sender, path: str | None = None,
                 destination: Sequence[str] | None = None, order: str = "none", shipment: str | None = None) -> DataFrame:
    """Send every batch in one job, write the receipts to ``path`` (below the shared
    checkpoint folder by default) and return them read back."""
    spark = payloads.sparkSession
    path = path or scratch_path(spark, "receipts")
    deliver(payloads, send, destination, order=order, shipment=shipment).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
