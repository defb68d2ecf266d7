"""Shipments that resume: an attempt log written while sending, and an anti-join on ``batch_key``.

A Spark job keeps all of its tasks' output or none, so receipts that are a job's output are
lost with a job that fails after half of its batches were accepted. Here every task
also writes what it did to log files of its own below a shared folder, ``LOG_ROWS`` rows a
file, each file closed before the next begins and the last one also when the task fails.

* The next run leaves out the batches that any log file calls sent (or over the limit).
* A task that Spark runs again first reads the files of its earlier attempts in this run.
* What can be sent twice is what a lost process had sent since its last closed file; receivers
  drop it by ``batch_key``, and the log keeps one row for each key.

The log is JSON lines that Spark reads as a table. Files are opened through Arrow's file systems
(local, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.batching import batch_keys
from eventloom.operators.prefix import DEFAULT_BROADCAST_ROWS, _null_safe_join
from eventloom.session import checkpoint_root
from eventloom.sinks.deliver import Sender, keyed_batches, ledger_columns, plain_values, row_slices, send_row, spread
from eventloom.sinks.retry import Retry

#: Rows of a log file: what a lost process may send again.
LOG_ROWS = 20


def shared_file(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a file in a folder that all executors share."""
    local = re.fullmatch(r"file:(?://)?(/.*)", uri)
    return (pafs.LocalFileSystem(), local[1]) if local else pafs.FileSystem.from_uri(uri)


class _Log:
    """The log files of one task attempt."""

    def __init__(self, folder: str) -> None:
        self._fs, self._folder = shared_file(folder)
        self._fs.create_dir(self._folder, recursive=True)
        self._rows: list[str] = []

    def earlier(self) -> set[str]:
        """Keys that this task's earlier attempts are done with."""
        done = set()
        for info in self._fs.get_file_info(pafs.FileSelector(self._folder)):
            with self._fs.open_input_stream(info.path) as f:
                rows = [json.loads(line) for line in f.read().splitlines()]
            done |= {r["batch_key"] for r in rows if r["outcome"] != "refused"}
        return done

    def add(self, row: dict) -> None:
        self._rows.append(json.dumps(row, default=str))
        if len(self._rows) == LOG_ROWS:
            self.close()

    def close(self) -> None:
        if self._rows:
            with self._fs.open_output_stream(f"{self._folder}/{uuid.uuid4().hex}.json") as f:
                f.write(("\n".join(self._rows) + "\n").encode())
            self._rows = []


def _log_columns(batches: DataFrame, dest: Sequence[str]) -> dict[str, str]:
    keyed = keyed_batches(batches, "", dest)
    return ledger_columns(keyed, dest, 0, Retry())


def read_log(spark: SparkSession, log: str, batches: DataFrame, destination: Sequence[str] | None = None) -> DataFrame | None:
    """One ledger row for each batch of the log, a sent one before a refused one; None if there is no log.
    ``batches`` gives the columns."""
    fs, path = shared_file(log)
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    columns = _log_columns(batches, batch_keys(batches, destination))
    rows = spark.read.schema(", ".join(f"`{c}` {t}" for c, t in columns.items())).option("recursiveFileLookup", "true").json(log)
    # whole lines only: a process that was lost while it wrote may leave a part of one
    rows = rows.where(F.col("batch_key").isNotNull() & F.col("outcome").isNotNull())
    best = F.max_by(F.struct(*columns), F.struct(F.col("outcome") != "refused", "attempts"))
    return rows.groupBy("batch_key").agg(best.alias("row")).select("row.*")


def send_logged(payloads: DataFrame, shipment: str, log: str, send: Sender, limit: int | None, tasks: int | None,
                order: str, retry: Retry, destination: Sequence[str] | None = None) -> None:
    """Send the batches that ``log`` isn't done with and add what became of them to it."""
    spark = payloads.sparkSession
    dest = batch_keys(payloads, destination)
    keyed = keyed_batches(payloads, shipment, dest)
    done = read_log(spark, log, payloads, dest)
    if done is not None:
        checkpoint_root(spark)
        # the keys are 64 characters each: measured, broadcast within the limits, else joined by a shuffle
        keys = done.where(F.col("outcome") != "refused").select("batch_key").checkpoint(eager=True)
        keyed = _null_safe_join(keyed, keys, ["batch_key"], "left_anti", DEFAULT_BROADCAST_ROWS)
    columns = ledger_columns(keyed, dest, 0, retry)
    run_folder = f"{log}/{uuid.uuid4().hex}"

    def run(batches):
        mine = _Log(f"{run_folder}/{TaskContext.get().partitionId():06d}")
        sent_before = mine.earlier()
        n = 0
        try:
            for part in row_slices(batches):
                values = {c: plain_values(part.column(c)) for c in part.schema.names}
                for i, (size, text, key) in enumerate(zip(values["n_bytes"], values["payload"], values["batch_key"])):
                    if key in sent_before:
                        continue
                    got = send_row(send, retry, limit, size, text, {d: values[d][i] for d in dest})
                    done_row = dict(zip(("status", "attempts", "outcome", "rejected", "dead_letter"), got))
                    mine.add({c: done_row[c] if c in done_row else values[c][i] for c in columns})
                    n += 1
        finally:
            mine.close()
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    spread(keyed, dest, tasks, order).mapInArrow(run, "n long").agg(F.sum("n")).collect()
