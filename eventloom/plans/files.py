"""Shipping event files from the tasks that read them.

A split of a file is read by one task, front to back, so its lines need no shuffle or sort
to be in order. Two scans of the files:

1. the bytes of each split (a small table), and from it where each split starts in its file,
   or in all files by path. No step takes these rows into one task: ranges of them are
   summed apart, and the driver adds up one number for each range;
2. the lines with their split's start, a running sum carried from record batch to record batch,
   and blocks cut where the batch id changes. A block inside a split is sent by that task.

Only a block that may go on in the next split, or that began in the one before, leaves its task: at most
two pieces of a split, which are put together and sent by a second, small job.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.functions.lines import byte_length
from eventloom.operators.batching import BLOCK_SIZE, MAX_PAYLOAD, repack_oversize, ship_totals
from eventloom.operators.prefix import DEFAULT_BROADCAST_BYTES, _null_safe_join, table_size
from eventloom.session import checkpoint_root, scratch_path
from eventloom.sinks.deliver import Sender, deliver, keyed_batches, ledger_columns, md5_sender, plain, send_row
from eventloom.sinks.retry import Retry
from eventloom.sources.text import FILE_SEGMENT

#: Rows of a range of the table of splits.
RANGE_ROWS = 100_000


def split_starts(lines: DataFrame, per_file: bool = True, raw: str = "raw", range_rows: int = RANGE_ROWS) -> DataFrame:
    """(file_path, file_block_start, _from): the bytes before each split, in its file or in all files by path."""
    checkpoint_root(lines.sparkSession)
    sizes = lines.groupBy(*FILE_SEGMENT).agg(F.sum(byte_length(raw) + 1).alias("_bytes"))
    before = lambda w: F.coalesce(F.sum("_bytes").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if per_file:
        return sizes.select(*FILE_SEGMENT, before(Window.partitionBy("file_path").orderBy("file_block_start")).alias("_from"))
    sizes = sizes.checkpoint(eager=True)
    n = max(1, -(-sizes.count() // range_rows))
    ranged = sizes.repartitionByRange(n, *FILE_SEGMENT).withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    totals = dict(ranged.groupBy("_range").agg(F.sum("_bytes")).collect())  # one number for range_rows splits
    starts, total = {}, 0
    for r in sorted(totals):
        starts[r], total = total, total + totals[r]
    base = F.element_at(F.create_map(*[F.lit(v).cast(t) for r, s in (starts or {0: 0}).items() for v, t in ((r, "int"), (s, "long"))]), F.col("_range"))
    return ranged.select(*FILE_SEGMENT, (base + before(Window.partitionBy("_range").orderBy(*FILE_SEGMENT))).alias("_from"))


def _blocks(block_size: int):
    """Lines of splits, in order, to blocks: file_path, file_block_start, batch_id, edge, n_events, n_bytes, payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, at, first, block, texts, n, size = None, 0, True, None, [], 0, 0

        def row(ends: bool) -> dict:
            edge = ends or first and began
            return {"file_path": split[0], "file_block_start": split[1], "batch_id": block, "edge": edge, "n_events": n, "n_bytes": size,
                    "payload": b"".join(texts).decode("utf-8", "replace")}

        began = False
        for b in batches:
            out = []
            files, starts, froms = (b.column(c) for c in ("file_path", "file_block_start", "_from"))
            raw = b.column("raw").cast(pa.large_binary())
            sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            coded = files.dictionary_encode().indices.to_numpy()
            start_of = starts.to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(coded) != 0) | (np.diff(start_of) != 0)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                here = (files[lo].as_py(), starts[lo].as_py())
                if here != split:
                    if texts:
                        out.append(row(True))
                    split, at, first, texts, n, size = here, froms[lo].as_py(), True, [], 0, 0
                    block = (at - 1) // block_size if at else None
                    goes_on = block
                ids = (at + np.cumsum(sizes[lo:hi]) - 1) // block_size
                at += int(sizes[lo:hi].sum())
                edges = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), hi - lo]
                for a, z in zip(edges, edges[1:]):
                    if int(ids[a]) != block:
                        if texts:
                            out.append(row(False))
                            first, texts, n, size = False, [], 0, 0
                        block = int(ids[a])
                    if not texts:
                        began = first and block == goes_on
                    texts.append(b"\n".join(raw.slice(lo + a, z - a).to_pylist()) + b"\n")
                    n, size = n + z - a, size + int(sizes[lo + a : lo + z].sum())
            if out:
                yield pa.RecordBatch.from_pylist(out, _SCHEMA)
        if texts:
            yield pa.RecordBatch.from_pylist([row(True)], _SCHEMA)

    return run


_SCHEMA = pa.schema([("file_path", pa.string()), ("file_block_start", pa.int64()), ("batch_id", pa.int64()), ("edge", pa.bool_()),
                     ("n_events", pa.int64()), ("n_bytes", pa.int64()), ("payload", pa.string())])
_BLOCK = "file_path string, file_block_start bigint, batch_id bigint, edge boolean, n_events bigint, n_bytes bigint, payload string"


def file_blocks(spark: SparkSession, path: str | list[str], block_size: int = BLOCK_SIZE, per_file: bool = True,
                broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The blocks of event files, cut by the tasks that read them. Rows with ``edge`` are pieces: those of one
    (file,) batch id make a block in the order of their splits (:func:`whole_blocks`)."""
    read = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_block_start"), F.col("value").alias("raw"))
    # The split table is read back by a hash of the split: 24 bytes a row whatever the paths' length.
    starts = split_starts(read, per_file).select(F.xxhash64(*FILE_SEGMENT).alias("_split"), "_from").checkpoint(eager=True)
    rows, size = table_size(starts)
    if starts.select("_split").distinct().count() != rows:
        raise RuntimeError("two splits have one hash")  # 64 bits: not to be expected below billions of splits
    keyed = read.withColumn("_split", F.xxhash64(*FILE_SEGMENT))
    if size > broadcast_bytes:  # beyond the limit the lines are shuffled to their split's start, and put in order again
        keyed = keyed.withColumn("_line", F.monotonically_increasing_id())
        joined = keyed.join(starts.hint("merge"), "_split").sortWithinPartitions("_split", "_line")
    else:
        joined = _null_safe_join(keyed, starts, ["_split"], "inner", rows, n_rows=rows)  # probes in scan order
    return joined.select(*FILE_SEGMENT, "_from", "raw").mapInArrow(_blocks(block_size), _BLOCK)


def whole_blocks(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Payload rows, by ``keys`` and batch id, of edge pieces put together."""
    return pieces.groupBy(*keys, "batch_id").agg(
        F.sum("n_events").alias("n_events"), F.sum("n_bytes").alias("n_bytes"),
        F.expr(f"listagg(payload, '') WITHIN GROUP (ORDER BY struct({', '.join(FILE_SEGMENT)}))").alias("payload"))


def ship_files(spark: SparkSession, path: str | list[str], send: Sender = md5_sender, block_size: int = BLOCK_SIZE,
               limit: int = MAX_PAYLOAD, per_file: bool = True, shipment: str | None = None, retry: Retry | None = None,
               repack: bool = False, destination: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ship event files; (receipts, rejected, totals) as :func:`eventloom.plans.ship.ship`, keyed by ``file_path`` (with
    ``per_file``) and the constant ``destination`` columns. One job sends the blocks inside splits, one the others."""
    shipment = uuid.uuid4().hex if shipment is None else shipment
    retry = retry or Retry(attempts=1, outcome=lambda status: "sent")
    dest = [*(["file_path"] if per_file else []), *(destination or {})]
    blocks = file_blocks(spark, path, block_size, per_file).select("*", *[F.lit(v).cast("string").alias(k) for k, v in (destination or {}).items()])
    held = [*FILE_SEGMENT, "edge"]
    if repack:  # a piece is no block yet
        blocks = repack_oversize(blocks, limit, [*dict.fromkeys([*dest, *held])], only=~F.col("edge"))
    keyed = keyed_batches(blocks, shipment, dest, keep=[c for c in held if c not in dest])
    columns = ledger_columns(keyed, dest, limit, retry)
    kinds = columns | {c: t for c, t in keyed.dtypes if c in held}

    def run(frames):
        for pdf in frames:
            rows = [(None, 0, "held", True, text) if edge else send_row(send, retry, limit, size, text, {d: plain(pdf[d].iat[i]) for d in dest})
                    for i, (edge, size, text) in enumerate(zip(pdf["edge"].tolist(), pdf["n_bytes"].tolist(), pdf["payload"].tolist()))]
            res = pdf.drop(columns=["payload"])
            for k, c in enumerate(("status", "attempts", "outcome", "rejected", "dead_letter")):
                res[c] = pd.Series([r[k] for r in rows], index=pdf.index, dtype={"attempts": "int32", "rejected": "bool"}.get(c, "object"))
            yield res[list(kinds)]

    folder = scratch_path(spark, "file-ledger")
    keyed.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in kinds.items())).write.parquet(f"{folder}/inside")
    inside = spark.read.parquet(f"{folder}/inside")
    edges = whole_blocks(inside.where("edge").withColumnRenamed("dead_letter", "payload"), dest)
    if repack:
        edges = repack_oversize(edges, limit, dest)
    deliver(edges, send, dest, limit=limit, shipment=shipment, retry=retry).write.parquet(f"{folder}/edges")
    ledger = inside.where(~F.col("edge")).select(*columns).unionByName(spark.read.parquet(f"{folder}/edges"))
    return ledger.where(~F.col("rejected")).drop("rejected", "dead_letter"), ledger.where("rejected"), ship_totals(ledger, limit, dest)
