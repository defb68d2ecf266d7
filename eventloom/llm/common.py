"""What the training-data operators share: words, fresh column names, written tables, global prefix sums."""

from __future__ import annotations

import string
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.session import scratch_path

#: A word is a run of characters other than the six ASCII white space ones.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back: lineage ends here.

    A lost executor costs the tasks it ran, not a recomputation of what is stored.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where a column of ``df`` already has it (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would also change other scripts)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` hinted for broadcast if it has at most ``max_rows`` rows, else as it is (a shuffled join).

    The count is measured on the data; call it on a stored table.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def small_bytes(df: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """``df`` hinted for broadcast if its values take at most ``max_bytes``, else as it is (a shuffled join).

    The size is measured on the data: bytes of strings and binaries, 16 for any other
    value, as each row is held as an object. Call it on a stored table.
    """
    sized = [F.coalesce(F.octet_length(c), F.lit(0)) + 16 if t in ("string", "binary") else F.lit(16) for c, t in df.dtypes]
    size = df.agg(F.sum(sum(sized[1:], sized[0]).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def global_prefix(df: DataFrame, group: str, order: Sequence[Column], value: str, out: str, parts: int = 64) -> DataFrame:
    """Running sum of ``value`` (the row included) within ``group`` by ``order``, no group in one task.

    Rows are range-partitioned by (group, order), so a group with a third of all
    rows lies over a third of the ranges. The ranges are stored with their number,
    which makes them the same for every later read; each adds the totals that its
    group has in earlier ranges. Those totals have at most ranges + groups rows.
    """
    seg = fresh(df, "seg")
    ranged = df.repartitionByRange(parts, F.col(group).asc_nulls_last(), *order).withColumn(seg, F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    total, base = fresh(df, "total"), fresh(df, "base")
    # A group lies in consecutive ranges: the totals of one group are few rows, one for each range that holds it.
    totals = ranged.groupBy(group, seg).agg(F.sum(value).alias(total))
    before = Window.partitionBy(group).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(totals.withColumn(base, F.coalesce(F.sum(total).over(before), F.lit(0))).select(
        F.col(group).alias(fresh(df, "g")), F.col(seg).alias(fresh(df, "s")), base), "bases")
    g, s = bases.columns[:2]
    here = Window.partitionBy(seg, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn(out, F.sum(value).over(here))
    joined = summed.join(bases, summed[group].eqNullSafe(bases[g]) & (summed[seg] == bases[s]))
    return joined.withColumn(out, F.col(out) + F.col(base)).drop(g, s, base, seg)
