"""Cutting event streams into size-bounded request payloads on line boundaries.

The sequential block loop of a file shipper (read B characters, send up to the
last LF, carry the rest) sends each event in call ``floor(end / B)``, where
``end`` is the zero-based offset of the event's terminating LF. So::

    batch_id = floor((running_sum(size(raw) + 1) - 1) / B)

per destination, in event order; computed here with the two-level running sum of
:mod:`eventloom.operators.prefix`. Events are never split: a line longer than
``B`` stays whole (its batch is larger than ``B``, and batch ids may skip).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.fields import NULL_TEXT
from eventloom.functions.lines import LF, byte_length, split_lines, wire_event, wire_text
from eventloom.operators.prefix import (
    DEFAULT_BROADCAST_ROWS,
    DEFAULT_SPLIT_BYTES,
    DEFAULT_SPLIT_ROWS,
    PKEY,
    SEG,
    _null_safe_join,
    _running_sum,
    exchange_on,
    join_segments,
    row_width,
)

# Read block size, and the largest payload accepted
# (1,000,000 less 16 K kept for headers).
BLOCK_SIZE = 524_288
MAX_PAYLOAD = 983_616


def present_destination(df: DataFrame, destination: Sequence[str] | None) -> list[str]:
    """Destination columns of event rows: as given, or those of ``index``,
    ``source``, ``sourcetype`` that are present."""
    if destination is not None:
        return list(destination)
    return [c for c in ("index", "source", "sourcetype") if c in df.columns]


# Columns of payload, receipt and ledger rows that are not destination keys.
BATCH_FIELDS = ("batch_id", "part", "n_events", "n_bytes", "payload", "batch_key", "status", "attempts", "outcome",
                "rejected", "dead_letter", "stream_batch_id")


def batch_keys(df: DataFrame, destination: Sequence[str] | None = None) -> list[str]:
    """Destination columns of payload (or receipt) rows: as given, or every column
    that is not a batch field, so payloads keyed by any destination columns keep them."""
    if destination is not None:
        return list(destination)
    return [c for c in df.columns if c not in BATCH_FIELDS]


def _raw_col(raw: Column | str) -> Column:
    return raw if isinstance(raw, Column) else F.col(raw)


def sent_text(raw: Column | str, normalize: bool = True) -> Column:
    """An event as it is sent: a null event is the text ``null``; with ``normalize``
    its line ends (CR, CRLF) are LFs, so that the payload needs no second split."""
    text = F.coalesce(_raw_col(raw).cast("string"), F.lit(NULL_TEXT))
    return wire_event(text) if normalize else text


def assign_batches(
    df: DataFrame,
    order: Sequence[str],
    block_size: int = BLOCK_SIZE,
    raw: Column | str = "raw",
    destination: Sequence[str] | None = None,
    segment: Sequence[str] | None = None,
    unit: str = "bytes",
    n_segments: int | None = None,
    split_rows: int | None = DEFAULT_SPLIT_ROWS,
    size: Column | None = None,
    normalize: bool = True,
    split_bytes: int | None = DEFAULT_SPLIT_BYTES,
) -> DataFrame:
    """Add ``batch_id`` (and ``_size`` = event size + 1 for its LF) per destination.

    A null event is sent, and sized, as ``null``. With ``normalize`` CR and CRLF in an
    event are sent, and sized, as LF.

    ``order`` is the event order (unique per destination), e.g. ``["event_id"]``
    or the file order key of :func:`eventloom.sources.read_event_file`. Large destinations
    are cut on it, fastest if its first column is a number, time or date; ``segment``
    (stored, order-preserving columns, as the file readers pass) replaces that search.
    ``raw`` may be a column name or an expression over the row (such as
    :func:`eventloom.functions.event_text`); an expression is only sized here,
    so the shuffle carries the narrower source columns, not the text.
    ``size`` may give the event's size directly (e.g.
    :func:`eventloom.functions.fields.event_size`) so the text is not built
    just to be measured; it must equal the size of ``raw`` in ``unit`` as it is sent
    (``event_size(..., wire=normalize)``); null stands for a null event.

    A destination of more than ``split_rows`` rows is cut into segments, and also one of more than
    ``split_bytes``, however few its rows: segments then hold about equal bytes, of the events or, where
    ``size`` spares building them, of the rows' columns. That sizes every row in the counting pass, too
    (``split_bytes=None``: it counts rows alone).
    """
    return _assign(df, order, block_size, raw, destination, segment, unit, n_segments, split_rows, size, normalize,
                   split_bytes=split_bytes)[0]


def _assign(df, order, block_size=BLOCK_SIZE, raw="raw", destination=None, segment=None, unit="bytes",
            n_segments=None, split_rows=DEFAULT_SPLIT_ROWS, size=None, normalize=True, start=None, split_bytes=DEFAULT_SPLIT_BYTES):
    if block_size <= 0:
        raise ValueError("block_size must be positive")
    dest = present_destination(df, destination)
    weight = row_width(df) if size is not None else None  # no value is formatted just to place the cuts
    size = F.coalesce(size, F.lit(len(NULL_TEXT))) if size is not None else byte_length(sent_text(raw, normalize), unit)
    size = size + F.lit(1)
    with_cum, mode, bases, measured = _running_sum(df, size, order, dest, segment, n_segments, out="_cum",
                                                   split_rows=split_rows, split_bytes=split_bytes, weight=weight)
    if start is not None:  # bytes that a destination had before these events
        with_cum = _started(with_cum, start, dest)
        bases = bases if bases is None else _started(bases, start, dest)
    cum = F.col("_cum") + F.col(FROM) if start is not None else F.col("_cum")
    return with_cum.withColumn("batch_id", batch_of(cum, block_size)).drop("_cum", FROM), mode, bases, measured


FROM = "_from"


def _started(df: DataFrame, start: DataFrame, dest: list[str]) -> DataFrame:
    if dest:
        return _null_safe_join(df, start, dest, "left", DEFAULT_BROADCAST_ROWS).withColumn(FROM, F.coalesce(FROM, F.lit(0)))
    only = start.agg(F.max(FROM)).first()[0]  # one destination: one number
    return df.withColumn(FROM, F.lit(only or 0).cast("long"))


def batch_of(cum: Column | str, block_size: int = BLOCK_SIZE) -> Column:
    """Batch of an event from the running byte count that ends at its LF."""
    c = cum if isinstance(cum, Column) else F.col(cum)
    return F.floor((c - 1) / F.lit(block_size)).cast("long")


def build_payloads(
    assigned: DataFrame,
    order: Sequence[str],
    raw: Column | str = "raw",
    destination: Sequence[str] | None = None,
    whole_segments: bool = False,
    segments: DataFrame | None = None,
    block_size: int | None = None,
    segments_size: tuple[int, int] | None = None,
    normalize: bool = True,
) -> DataFrame:
    """One row per (destination, batch): ``batch_id, n_events, n_bytes, payload``.
    ``n_events`` counts events (rows); one whose text holds line ends is several lines.

    Each event is followed by one LF. Pieces are first joined per
    (destination, segment, batch) where the rows already sit after the running
    sum (no exchange), then pieces, at most a few per batch, are joined per batch.
    Group sizes are bounded by the block size plus the longest event. When no
    destination was cut into segments (``whole_segments``), every piece already is
    a whole payload and the second grouping, with its exchange, is skipped.

    With the per-segment offsets (``segments``, from the running sum, and
    ``block_size``) only the pieces that continue a batch begun in an earlier
    segment move: each is re-keyed to the segment holding its batch's first line,
    and the pieces are regrouped on the hash of that owning segment. A piece that
    owns its batch keeps its hash, so it stays in the partition it is in.
    """
    dest = present_destination(assigned, destination)
    seg_keys = [PKEY, *dest, SEG] if PKEY in assigned.columns else [*dest, SEG]
    by_order = ", ".join(f"`{c}`" for c in order)
    lines = assigned.withColumn("_line", F.concat(sent_text(raw, normalize), F.lit(LF)))
    pieces = lines.groupBy(*seg_keys, "batch_id").agg(
        F.expr(f"listagg(_line, '') WITHIN GROUP (ORDER BY {by_order})").alias("_piece"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("_size").alias("_b"),
    )
    if whole_segments:
        return pieces.select(*dest, "batch_id", F.col("_n").cast("long").alias("n_events"),
                             F.col("_b").cast("long").alias("n_bytes"), F.col("_piece").alias("payload"))
    if segments is not None and block_size and PKEY in assigned.columns:
        return _merge_at_owner(pieces, segments, dest, block_size, segments_size)
    return pieces.groupBy(*dest, "batch_id").agg(
        F.sum("_n").cast("long").alias("n_events"),
        F.sum("_b").cast("long").alias("n_bytes"),
        F.expr(f"listagg(_piece, '') WITHIN GROUP (ORDER BY {SEG})").alias("payload"),
    )


def _merge_at_owner(pieces: DataFrame, segments: DataFrame, dest: list[str], block_size: int,
                    segments_size: tuple[int, int] | None = None) -> DataFrame:
    keys = [*dest, SEG]
    # per segment: the batch its predecessor ended in (a piece of that batch here
    # continues it) and the segment holding that batch's first line, which is the
    # segment just before the run of segments that all continue the same batch
    w = Window.partitionBy(*dest).orderBy(SEG)
    before = F.col("_size_base") + F.col(FROM) if FROM in segments.columns else F.col("_size_base")
    ended = F.when(F.col("_size_base") > 0, batch_of(before, block_size))
    table = segments.select(*keys, ended.alias("_c"))
    table = table.select(*keys, "_c", F.lag(SEG).over(w).alias("_prev"), F.lag("_c").over(w).alias("_prev_c"))
    starts = F.col("_prev_c").isNull() | (F.col("_prev_c") != F.col("_c"))
    owner = F.last(F.when(starts, F.col("_prev")), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # a small window over the checkpointed offsets: cheap to recompute, not checkpointed again
    table = table.select(*keys, "_c", owner.alias("_owner"))

    # same rows as the measured offsets table; an upper bound of its bytes: ``_c``
    # replaces the base column and ``_owner`` adds at most one more segment value
    measured = None if segments_size is None else (segments_size[0], 2 * segments_size[1] + 8 * segments_size[0])
    flagged, _ = join_segments(pieces, table, keys, "left", measured=measured)
    moves = F.col("_c").isNotNull() & (F.col("batch_id") == F.col("_c"))
    target = flagged.withColumn("_tseg", F.when(moves, F.col("_owner")).otherwise(F.col(SEG)))
    target = target.withColumn("_tkey", F.xxhash64(*[F.col(d) for d in dest], F.col("_tseg")))
    return exchange_on(target, "_tkey", segments_size[0] if segments_size else None).groupBy("_tkey", *dest, "_tseg", "batch_id").agg(
        F.sum("_n").cast("long").alias("n_events"),
        F.sum("_b").cast("long").alias("n_bytes"),
        F.expr(f"listagg(_piece, '') WITHIN GROUP (ORDER BY {SEG})").alias("payload"),
    ).select(*dest, "batch_id", "n_events", "n_bytes", "payload")


def batch_events(
    df: DataFrame,
    order: Sequence[str],
    block_size: int = BLOCK_SIZE,
    raw: Column | str = "raw",
    destination: Sequence[str] | None = None,
    segment: Sequence[str] | None = None,
    unit: str = "bytes",
    split_rows: int | None = DEFAULT_SPLIT_ROWS,
    size: Column | None = None,
    normalize: bool = True,
    start: DataFrame | None = None,
    split_bytes: int | None = DEFAULT_SPLIT_BYTES,
) -> DataFrame:
    """:func:`assign_batches` then :func:`build_payloads`. ``start`` (destination columns and
    ``_from``) gives the bytes that a destination's earlier events took, which these continue."""
    assigned, mode, bases, measured = _assign(df, order, block_size, raw, destination, segment, unit,
                                              split_rows=split_rows, size=size, normalize=normalize, start=start, split_bytes=split_bytes)
    return build_payloads(assigned, order, raw, destination, whole_segments=(mode == "none"), segments=bases,
                          block_size=block_size, segments_size=measured, normalize=normalize)


def value_payloads(df: DataFrame, text: Column | str, keys: Sequence[str] = (), unit: str = "bytes") -> DataFrame:
    """Each text value sent as one request: every line (LF, CR or CRLF) ended by one
    LF. Returns ``keys``, ``batch_id`` (0), ``n_events`` (lines), ``n_bytes`` and
    ``payload``; pass it to :func:`split_oversize` / ``deliver`` like batches."""
    t = _raw_col(text)
    payload = wire_text(t)
    return df.select(
        *keys,
        F.lit(0).cast("long").alias("batch_id"),
        F.size(split_lines(t)).cast("long").alias("n_events"),
        byte_length(payload, unit).alias("n_bytes"),
        payload.alias("payload"),
    )


def oversize(payloads: DataFrame, limit: int = MAX_PAYLOAD) -> Column:
    return F.col("n_bytes") > F.lit(limit)


def split_oversize(payloads: DataFrame, limit: int = MAX_PAYLOAD) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). Rejected batches go to a dead-letter output; the job goes on."""
    return payloads.where(~oversize(payloads, limit)), payloads.where(oversize(payloads, limit))


def repack_oversize(payloads: DataFrame, limit: int = MAX_PAYLOAD, destination: Sequence[str] | None = None,
                    unit: str = "bytes", only: Column | None = None) -> DataFrame:
    """Batches with a ``part`` number: one over ``limit`` is cut on its line ends into parts
    that fit, by next fit in line order, so that only a line which is over the limit alone
    stays over it, as a part of its own. Other batches are part 0 as they are.

    The cuts are a fold over the batch's line sizes, which a batch bounds (a block plus a
    line); the fold keeps the open part's size and the cuts alone. ``n_events`` of a
    repacked part counts its lines: to the receiver each line is an event.
    ``only`` restricts what is cut.
    """
    dest = batch_keys(payloads, destination)
    text = F.col("payload")
    lines = F.split(F.when(text.endswith(LF), text.substr(F.lit(1), F.length(text) - 1)).otherwise(text), LF, -1)
    start = F.struct(F.array(F.lit(1)).alias("cuts"), F.lit(0).cast("long").alias("fill"), F.lit(1).alias("at"))

    def add(open_, line):
        size = byte_length(line, unit) + F.lit(1)
        closes = (open_["fill"] > 0) & (open_["fill"] + size > F.lit(limit))
        return F.struct(F.when(closes, F.array_append(open_["cuts"], open_["at"])).otherwise(open_["cuts"]).alias("cuts"),
                        F.when(closes, size).otherwise(open_["fill"] + size).alias("fill"), (open_["at"] + 1).alias("at"))

    big = oversize(payloads, limit) if only is None else oversize(payloads, limit) & only
    cuts = F.when(big, F.aggregate(lines, start, add, lambda done: done["cuts"])).otherwise(F.array(F.lit(1)))
    parts = payloads.select(*dest, "batch_id", "n_events", "n_bytes", "payload", cuts.alias("_cuts")).select(
        "*", F.posexplode("_cuts").alias("part", "_at"))
    whole = F.size("_cuts") == 1
    upto = F.coalesce(F.get("_cuts", F.col("part") + 1), F.size(lines) + 1)
    piece = F.slice(lines, F.col("_at"), upto - F.col("_at"))
    cut = parts.withColumn("_n", F.when(whole, F.col("n_events")).otherwise(F.size(piece).cast("long"))).withColumn(
        "_text", F.when(whole, F.col("payload")).otherwise(F.concat(F.array_join(piece, LF), F.lit(LF))))
    return cut.select(*dest, "batch_id", "part", F.col("_n").alias("n_events"),
                      F.when(whole, F.col("n_bytes")).otherwise(byte_length("_text", unit)).alias("n_bytes"),
                      F.col("_text").alias("payload"))


def ship_totals(payloads: DataFrame, limit: int = MAX_PAYLOAD, destination: Sequence[str] | None = None) -> DataFrame:
    """Per destination: bytes read, bytes sent, calls made, batches rejected, events.

    A ledger with outcomes (see :class:`eventloom.sinks.retry.Retry`) counts as sent what the
    receiver accepted, and ``calls`` every attempt; it adds ``refused`` (batches given up) and
    ``retried`` (accepted after more than one attempt)."""
    dest = batch_keys(payloads, destination)
    big = oversize(payloads, limit)
    if "outcome" not in payloads.columns:
        sent, calls, more = ~big, F.count_if(~big), []
    else:
        sent, calls = F.col("outcome") == "sent", F.coalesce(F.sum("attempts"), F.lit(0))
        more = [F.count_if(F.col("outcome") == "refused").cast("long").alias("refused"),
                F.count_if(sent & (F.col("attempts") > 1)).cast("long").alias("retried")]
    return payloads.groupBy(*dest).agg(
        F.sum("n_bytes").cast("long").alias("read_bytes"),
        F.coalesce(F.sum(F.when(sent, F.col("n_bytes"))), F.lit(0)).cast("long").alias("sent_bytes"),
        calls.cast("long").alias("calls"),
        F.count_if(big).cast("long").alias("rejected"),
        F.sum("n_events").cast("long").alias("n_events"),
        *more,
    )
