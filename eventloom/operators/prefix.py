"""Distributed running sums in two levels.

A running sum written as one window per partition (destination) puts every row
of a partition in one task; with one destination, or one that holds a third of
all rows, that task holds a third of the data. Instead:

1. cut the order into *segments*: stored, order-preserving values. Either
   explicit columns such as ``(file_path, file_block_start)``, or buckets whose
   boundaries come from a fixed-seed sample of the order. A number, time or date
   that comes first is bucketed by quantiles of its value as a double (a JVM-side
   binary search; rounding can only put neighbours in one bucket). Where that is
   not enough - a first column of another type, or keys that fill several
   quantiles alone, because they repeat or because doubles cannot tell them apart -
   the boundaries are whole order keys, compared in their own types column by
   column, so text keys and heavy leading values are cut like any others. Only
   *hot* partitions are cut: those with more than ``split_rows`` rows. Smaller ones
   are one segment with base 0, handled whole by one window task;
2. sum each hot (partition, segment) and run a small window over those totals to
   get each segment's base offset. That table has at most
   ``hot partitions x segments`` rows; it is checkpointed to the shared
   checkpoint folder, counted, and broadcast only below ``broadcast_rows``
   (else the join shuffles on the same keys as the window that follows);
3. add the base to a running sum inside each (partition, segment).

Segment keys are never ``spark_partition_id()``: they must not change when a
task is recomputed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DateType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from eventloom.session import checkpoint_root

SEG = "_seg"
HOT = "_hot"
PKEY = "_pkey"  # hash of (partition, segment): the one exchange the window and later groupings reuse

# Largest small-side table that is broadcast (rows and measured bytes); above
# either bound the join shuffles.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# A partition with more rows than this is cut into segments of about a quarter of it.
DEFAULT_SPLIT_ROWS = 1_000_000
# Likewise for a partition of more bytes than this, however few its rows (callers that know their rows' sizes).
DEFAULT_SPLIT_BYTES = 64 * 1024 * 1024
# A task takes about this many segments at most, where the session's shuffle partitions would give it more.
SEGMENTS_PER_TASK = 4
# Boundaries are literals of the plan; beyond these many, segments hold more rows.
MAX_SEGMENTS = 10_000


def default_segments(rows: int, split_rows: int | None = DEFAULT_SPLIT_ROWS, size: int = 0,
                     split_bytes: int | None = None) -> int:
    """Segments for so many rows: a quarter of ``split_rows`` in each, or of ``split_bytes`` if that gives more."""
    per = max(1, (split_rows if split_rows is not None else DEFAULT_SPLIT_ROWS) // 4)
    by_size = math.ceil(size / max(1, split_bytes // 4)) if split_bytes else 0
    return max(2, min(MAX_SEGMENTS, max(math.ceil(rows / per), by_size)))


def key_number(df: DataFrame, key: str) -> Column | None:
    """An order-preserving number for ``key`` (numbers, timestamps, dates); ``None``
    for other types, which then cannot be cut into quantile segments."""
    kind = df.schema[key].dataType
    c = F.col(key)
    if isinstance(kind, NumericType):
        return c.cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double")
    return None


# Rows sampled per segment to place the quantile boundaries.
SAMPLE_ROWS_PER_SEGMENT = 200


class Weight(NamedTuple):
    """The size of a row, and the sum of all that a sample is drawn from."""

    size: Column
    total: int


def _drawn(df: DataFrame, wanted: int, rows: int | None, weight: Weight | None, seed: int) -> DataFrame:
    """About ``wanted`` rows by a fixed seed: each with equal chance, or with one that grows with its size, so that
    boundaries among them cut equal sizes. A row of over ``total / wanted`` is always in, and counts as often as it
    outweighs that (``_times``, which is 1 otherwise)."""
    if weight is not None and weight.total:
        share = weight.size * F.lit(wanted / weight.total)
        return df.withColumn("_times", F.floor(share + F.rand(seed)).cast("int")).where(F.col("_times") > 0)
    frac = wanted / rows if rows else 1.0
    return (df.sample(withReplacement=False, fraction=frac, seed=seed) if frac < 1.0 else df).withColumn("_times", F.lit(1))


def _quantiles(df: DataFrame, key: str, n: int, total_rows: int | None = None, weight: Weight | None = None) -> list[float]:
    """``n - 1`` quantiles of ``key`` (repeats kept), on a fixed-seed sample of about
    ``200 n`` rows with ``approxQuantile`` (a tree aggregation), so the sketches
    merged grow with the number of segments, not with the data."""
    probs = [i / n for i in range(1, n)]
    drawn = _drawn(df, SAMPLE_ROWS_PER_SEGMENT * n, total_rows, weight, 17)
    keyed = drawn.select(key_number(df, key).alias("_k"), "_times").where(F.col("_k").isNotNull() & ~F.isnan("_k"))
    if weight is not None:  # a row that outweighs a segment is several quantiles, but not more often than there are
        keyed = keyed.withColumn("_k", F.explode(F.array_repeat("_k", F.least("_times", F.lit(SAMPLE_ROWS_PER_SEGMENT * n)))))
    return [float(b) for b in keyed.approxQuantile("_k", probs, 1.0 / (4 * n)) if b is not None and not math.isnan(b)]


def _to_splits(quantiles: list[float]) -> list[float]:
    # at least one boundary (no keys: any will do)
    return [-math.inf, *(sorted(set(quantiles)) or [0.0]), math.inf]


def _splits(df: DataFrame, key: str, n: int, total_rows: int | None = None) -> list[float]:
    """At most ``n - 1`` quantile boundaries of ``key``. They only balance the
    segments; exactness of the sums does not depend on them."""
    return _to_splits(_quantiles(df, key, n, total_rows))


def _bucketize(df: DataFrame, key: str, splits: list[float], out: str) -> DataFrame:
    tmp = f"{out}__key"
    with_key = df.withColumn(tmp, key_number(df, key))
    bucketed = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep").transform(with_key)
    return bucketed.withColumn(out, F.col(out).cast("int")).drop(tmp)


def quantile_segments(df: DataFrame, key: str, n_segments: int | None = None, out: str = SEG) -> DataFrame:
    """Add ``out``: an order-preserving bucket of ``key`` with about equal row counts."""
    rows = df.count()
    return _bucketize(df, key, _splits(df, key, n_segments or default_segments(rows), rows), out)


def hot_partitions(df: DataFrame, partition_by: Sequence[str], split_rows: int = DEFAULT_SPLIT_ROWS,
                   size: Column | None = None, split_bytes: int | None = None) -> tuple[DataFrame, int, int] | None:
    """The partitions with more than ``split_rows`` rows, or ``split_bytes`` of ``size``, as a checkpointed
    DataFrame of their keys, their row count ``_n`` and ``_hot = true``, with the total rows
    and size they hold; ``None`` when there are none. The list stays off the driver."""
    by_size = size is not None and split_bytes is not None
    counts = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_n"), (F.sum(size) if by_size else F.lit(0)).cast("long").alias("_b"))
    over = (F.col("_n") > split_rows) | (F.col("_b") > split_bytes) if by_size else F.col("_n") > split_rows
    hot = counts.where(over).withColumn(HOT, F.lit(True)).checkpoint(eager=True)
    rows, total = hot.agg(F.sum("_n"), F.sum("_b")).first()
    return (hot.drop("_b"), int(rows), int(total)) if rows else None


_FIXED_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}


def _width_parts(col: Column, kind) -> tuple[list[Column], int]:
    """Variable-size parts to measure, and the fixed bytes, of one column."""
    if isinstance(kind, (StringType, BinaryType)):
        return [F.octet_length(col)], 0
    if isinstance(kind, StructType):
        cols, fixed = [], 0
        for f in kind.fields:
            c, w = _width_parts(col[f.name], f.dataType)
            cols, fixed = cols + c, fixed + w
        return cols, fixed
    name = kind.simpleString()
    return [], 16 if name.startswith("decimal") else _FIXED_WIDTH.get(name, 8)


def row_width(df: DataFrame) -> Column:
    """The bytes of a row's columns: strings and binaries as they are, other values at fixed width."""
    measured, fixed = [], 0
    for f in df.schema.fields:
        c, w = _width_parts(F.col(f"`{f.name}`"), f.dataType)
        measured, fixed = measured + c, fixed + w
    width = F.lit(fixed).cast("long")
    for m in measured:
        width = width + F.coalesce(m, F.lit(0))
    return width


def exchange_on(df: DataFrame, key: str, segments: int | None = None) -> DataFrame:
    """``df`` shuffled on ``key``; to more tasks than the session's where ``segments`` would crowd those."""
    wanted = math.ceil((segments or 0) / SEGMENTS_PER_TASK)
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.repartition(wanted, key) if wanted > session else df.repartition(key)


def table_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a small table: one aggregation that measures strings and
    binaries exactly (inside structs too) and counts other values at fixed width."""
    measured, fixed = [], 0
    for f in df.schema.fields:
        c, w = _width_parts(F.col(f.name), f.dataType)
        measured, fixed = measured + c, fixed + w
    sums = [F.coalesce(F.sum(m), F.lit(0)).alias(f"w{i}") for i, m in enumerate(measured)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    n = int(row["n"])
    return n, n * fixed + sum(int(row[f"w{i}"]) for i in range(len(measured)))


def _null_safe_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str, broadcast_rows: int,
                    n_rows: int | None = None, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join on ``keys`` (nulls match nulls). ``small`` is broadcast only when its
    measured size is within ``broadcast_rows`` and ``broadcast_bytes`` (callers
    pass ``n_rows=0`` for tables bounded by construction); otherwise the join
    shuffles both sides on the keys."""
    renamed = small.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[c for c in small.columns if c not in keys])
    if n_rows is None:
        n, size = table_size(renamed)  # cheap: the table is checkpointed
        fits = n <= broadcast_rows and size <= broadcast_bytes
    else:
        fits = n_rows <= broadcast_rows
    side = F.broadcast(renamed) if fits else renamed
    cond = [big[k].eqNullSafe(side[f"__r_{k}"]) for k in keys]
    return big.join(side, cond, how).drop(*[f"__r_{k}" for k in keys])


def _comparable(df: DataFrame, c: str) -> Column:
    """An order column as a value that a boundary read by the driver can be compared
    with exactly: times and dates as whole numbers, everything else in its own type."""
    kind = df.schema[c].dataType
    if isinstance(kind, TimestampType):
        return F.unix_micros(F.col(c))
    if isinstance(kind, DateType):
        return F.unix_date(F.col(c))
    if isinstance(kind, TimestampNTZType):
        return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.col(c)


def _key_segments(df: DataFrame, order: Sequence[str], n: int, rows: int | None, where: Column | None,
                  weight: Weight | None = None) -> DataFrame:
    """``_seg`` = how many of at most ``n - 1`` boundaries, whole keys in ``order``, are
    not after the row's key. Boundaries are every ``SAMPLE_ROWS_PER_KEY``-th row of
    a sorted sample (bounded by ``SAMPLE_ROWS_PER_KEY * n`` rows)."""
    chosen = df if where is None else df.where(where)
    drawn = _drawn(chosen, SAMPLE_ROWS_PER_KEY * n, rows or chosen.count(), weight, 23)
    sampled = drawn.select(F.struct(*[_comparable(df, c).alias(f"k{i}") for i, c in enumerate(order)]).alias("key"))
    got = sampled.agg(F.sort_array(F.collect_list("key")).alias("keys")).select(
        F.size("keys").alias("n"), F.col("keys")).first()
    step = max(1, math.ceil(got["n"] / n))
    bounds = sorted(range(step, got["n"], step))
    keys = list(dict.fromkeys(tuple(got["keys"][i]) for i in bounds))
    if not keys:
        return df.withColumn(SEG, F.lit(0))
    fields = sampled.schema["key"].dataType.fields
    table = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(k, fields)]) for k in keys])
    key = F.struct(*[_comparable(df, c).alias(f.name) for c, f in zip(order, fields)])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(keys).bit_length()))])
    # binary search: take a step while the boundary it reaches is not after the key
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(keys)) & (F.get(table, at + step - 1) <= key), at + step).otherwise(at))
    return df.withColumn(SEG, found)


# Rows of the sorted sample per boundary that is a whole key.
SAMPLE_ROWS_PER_KEY = 20


def _segment(df: DataFrame, order: Sequence[str], n: int, rows: int | None, where: Column | None,
             weight: Weight | None = None) -> DataFrame:
    """``_seg`` for the rows selected by ``where`` (all rows when ``None``): buckets of
    ``order[0]`` as a double where they are balanced, buckets of whole keys elsewhere."""
    key = order[0]
    if key_number(df, key) is None:
        return _key_segments(df, order, n, rows, where, weight)
    q = _quantiles(df if where is None else df.where(where), key, n, rows, weight)
    if q and len(set(q)) <= 0.9 * len(q):  # some values fill two or more quantiles
        return _key_segments(df, order, n, rows, where, weight)
    return _bucketize(df, key, _to_splits(q), SEG)


def add_segments(df: DataFrame, order: Sequence[str], partition_by: Sequence[str] = (),
                 segment: Sequence[str] | None = None, n_segments: int | None = None,
                 split_rows: int | None = DEFAULT_SPLIT_ROWS,
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS, size: Column | None = None,
                 split_bytes: int | None = None) -> tuple[DataFrame, str]:
    """Add ``_seg`` (and ``_hot`` when only some partitions are cut).

    Returns the frame and the mode: ``'all'`` (every row segmented), ``'hot'``
    (rows with ``_hot`` segmented, others ``_seg = 0``), ``'none'`` (one segment
    per partition, ``_seg = 0``).
    """
    if segment:
        cols = [F.col(c) for c in segment]
        return df.withColumn(SEG, cols[0] if len(cols) == 1 else F.struct(*cols)), "all"
    if split_rows is None:  # never cut (the caller knows partitions are small): no counting job
        return df.withColumn(SEG, F.lit(0)), "none"
    by_size = size is not None and split_bytes is not None
    if not partition_by:
        total, held = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0)) if by_size else F.lit(0)).first()
        if total <= split_rows and not (by_size and held > split_bytes):
            return df.withColumn(SEG, F.lit(0)), "none"
        n = n_segments or default_segments(total, split_rows, held, split_bytes)
        return _segment(df, order, n, total, None, Weight(size, held) if by_size else None), "all"
    found = hot_partitions(df, partition_by, split_rows, size, split_bytes)
    if found is None:
        return df.withColumn(SEG, F.lit(0)), "none"
    hot, hot_rows, held = found
    flagged = _null_safe_join(df, hot.drop("_n"), list(partition_by), "left", broadcast_rows)
    flagged = flagged.withColumn(HOT, F.coalesce(F.col(HOT), F.lit(False)))
    n = n_segments or default_segments(hot_rows, split_rows, held, split_bytes)
    segmented = _segment(flagged, order, n, hot_rows, F.col(HOT), Weight(size, held) if by_size else None)
    return segmented.withColumn(SEG, F.when(F.col(HOT), F.col(SEG)).otherwise(F.lit(0))), "hot"


def _running_sums(
    df: DataFrame,
    sizes: dict[str, Column],
    order: Sequence[str],
    partition_by: Sequence[str] = (),
    segment: Sequence[str] | None = None,
    n_segments: int | None = None,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    split_rows: int | None = DEFAULT_SPLIT_ROWS,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    split_bytes: int | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Add one inclusive running sum per ``sizes`` entry, per ``partition_by`` in
    ``order``, all in the same pass (one offsets table, one exchange, one sort).

    ``order`` must be unique within a partition (ties would make the sums depend
    on row arrival order). Keeps ``_seg`` and the per-row sizes ``_sz_<i>`` (in
    ``sizes`` order) for later per-segment work. ``weight`` is what ``split_bytes`` bounds,
    the first of ``sizes`` by default.
    """
    checkpoint_root(df.sparkSession)
    first_size = weight if weight is not None else next(iter(sizes.values()))
    seg_df, mode = add_segments(df, order, partition_by, segment, n_segments, split_rows, broadcast_rows, first_size, split_bytes)
    tmp = {out: f"_sz_{i}" for i, out in enumerate(sizes)}
    keys = [*partition_by, SEG]
    base_cols = [c for c in seg_df.columns if c != HOT]

    def sized(frame: DataFrame) -> DataFrame:
        return frame.select(*[c for c in frame.columns if c != HOT],
                            *[c.cast("long").alias(tmp[o]) for o, c in sizes.items()])

    # Exchange once on a hash of the window keys, then size rows after it. The
    # hash column is part of the window spec (and of later per-segment groupings)
    # so the exchange satisfies them even when Catalyst folds constant keys
    # (e.g. a destination column that is null everywhere) out of those specs.
    w = Window.partitionBy(PKEY, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out_cols = [PKEY, *base_cols, *tmp.values()]

    def exchanged(frame: DataFrame) -> DataFrame:
        return sized(frame.withColumn(PKEY, F.xxhash64(*keys)).repartition(PKEY))

    if mode == "none":
        return exchanged(seg_df).select(*out_cols, *[F.sum(t).over(w).alias(o) for o, t in tmp.items()]), mode, None, None

    cut = seg_df.where(F.col(HOT)) if mode == "hot" else seg_df
    totals = sized(cut).groupBy(*keys).agg(*[F.sum(t).alias(f"{t}_tot") for t in tmp.values()])
    w_tot = Window.partitionBy(*partition_by).orderBy(SEG).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bases = totals.select(*keys, *[(F.sum(f"{t}_tot").over(w_tot) - F.col(f"{t}_tot")).alias(f"{t}_base")
                                   for t in tmp.values()])
    bases = bases.checkpoint(eager=True)

    how = "left" if mode == "hot" else "inner"
    big = seg_df.select(*base_cols).withColumn(PKEY, F.xxhash64(*keys))
    measured = table_size(bases)  # cheap: the table is checkpointed and small
    joined, broadcasted = join_segments(big, bases, keys, how, broadcast_rows, broadcast_bytes, measured)
    if broadcasted:
        joined = exchange_on(joined, PKEY, measured[0])  # the exchange the window needs
    joined = sized(joined)
    return joined.select(
        *out_cols,
        *[(F.coalesce(F.col(f"{t}_base"), F.lit(0)) + F.sum(t).over(w)).alias(o) for o, t in tmp.items()],
    ), mode, bases, measured


def join_segments(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str,
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                  broadcast_bytes: int | None = None,
                  measured: tuple[int, int] | None = None) -> tuple[DataFrame, bool]:
    """Join a small per-segment table onto ``big`` (which holds ``_pkey``, the hash of
    ``keys``); keys match null-safely. Returns the frame and whether it was broadcast.

    The small side is measured and broadcast only within ``broadcast_rows`` and
    ``broadcast_bytes``, which keeps ``big``'s partitioning. Beyond that both sides
    meet on ``_pkey`` alone (the keys as a residual condition), so a ``big``
    already partitioned on ``_pkey`` is not exchanged and any other is exchanged
    exactly as the window after it needs. ``measured`` (rows, bytes) skips
    measuring ``small`` again when the caller knows its size."""
    limit = DEFAULT_BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    n, size = measured if measured is not None else table_size(small)
    if n <= broadcast_rows and size <= limit:
        return _null_safe_join(big, small, keys, how, broadcast_rows, n_rows=0), True
    right = small.select(F.xxhash64(*keys).alias("__r_pkey"), *[F.col(k).alias(f"__r_{k}") for k in keys],
                         *[c for c in small.columns if c not in keys])
    cond = big[PKEY] == right["__r_pkey"]
    for k in keys:
        cond = cond & F.coalesce(big[k] == right[f"__r_{k}"], big[k].isNull() & right[f"__r_{k}"].isNull())
    return big.join(right, cond, how).drop("__r_pkey", *[f"__r_{k}" for k in keys]), False


def running_sums(
    df: DataFrame,
    sizes: dict[str, Column],
    order: Sequence[str],
    partition_by: Sequence[str] = (),
    segment: Sequence[str] | None = None,
    n_segments: int | None = None,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    split_rows: int | None = DEFAULT_SPLIT_ROWS,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Add one inclusive running sum per ``sizes`` entry, per ``partition_by`` in
    ``order`` (see :func:`_running_sums`)."""
    return _running_sums(df, sizes, order, partition_by, segment, n_segments, broadcast_rows, split_rows,
                         broadcast_bytes)[0]


def running_sum(
    df: DataFrame,
    size: Column | str,
    order: Sequence[str],
    partition_by: Sequence[str] = (),
    segment: Sequence[str] | None = None,
    n_segments: int | None = None,
    out: str = "cum",
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    split_rows: int | None = DEFAULT_SPLIT_ROWS,
) -> DataFrame:
    """Add ``out`` = inclusive running sum of ``size`` (see :func:`running_sums`);
    also keeps the per-row size as ``_size``."""
    return _running_sum(df, size, order, partition_by, segment, n_segments, out, broadcast_rows, split_rows)[0]


def _running_sum(df, size, order, partition_by=(), segment=None, n_segments=None, out="cum",
                 broadcast_rows=DEFAULT_BROADCAST_ROWS, split_rows=DEFAULT_SPLIT_ROWS, split_bytes=None, weight=None):
    """(frame, mode, offsets table or None, its measured (rows, bytes) or None); the
    offsets' base column is ``_size_base``."""
    size_c = size if isinstance(size, Column) else F.col(size)
    res, mode, bases, measured = _running_sums(df, {out: size_c}, order, partition_by, segment, n_segments,
                                               broadcast_rows, split_rows, split_bytes=split_bytes, weight=weight)
    if bases is not None:
        bases = bases.withColumnRenamed("_sz_0_base", "_size_base")
    return res.withColumnRenamed("_sz_0", "_size"), mode, bases, measured
