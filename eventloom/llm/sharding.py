"""Sharding by a permutation-filled lookup table.

Each shard has a permutation of the slots of a table of prime size (an offset and a
step from hashes of its name). The shards take turns: each claims the first slot of
its permutation that is still free, until none is. A document's slot is a hash of its
id modulo the size, and the table, which is broadcast (its size is the parameter
``slots``, whatever the data), names its shard. All shards get the same number of
slots but for one, and adding or removing a shard moves few slots beyond its own.

Defined cases: a null key has a slot like any other; repeated rows go to one shard;
an empty table gives no rows; other columns pass through, and a column that has the
name of an added one stays, under the name that it has (the added column is named by
the caller).
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import fresh

#: A prime of over a hundred times the number of shards keeps them within one per cent of each other.
SLOTS = 65_537
SHARDS = 64


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:05d}" for k in range(n)]


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard."""
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the number of slots must be prime, not {slots}")
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("shards must have different names, and there must be one at least and a slot for each")
    place = [_number(s, "offset") % slots for s in shards]
    step = [_number(s, "step") % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while free:
        for k in range(len(shards)):
            while table[place[k]] >= 0:
                place[k] = (place[k] + step[k]) % slots
            table[place[k]] = k
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("null")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") % slots).cast("int")


def place(documents: DataFrame, shards: Sequence[str], key: str = "doc_id", out: str = "shard", slots: int = SLOTS) -> DataFrame:
    """``documents`` with the slot of each row's key (``<out>_slot``) and the shard that claimed it (``out``)."""
    spark = documents.sparkSession
    rows = [(k, shards[s]) for k, s in enumerate(lookup_table(shards, slots))]
    slot, at = fresh(documents, f"{out}_slot"), fresh(documents, "table_slot")
    name = fresh(documents, out)
    table = spark.createDataFrame(rows, f"`{at}` int, `{name}` string")
    placed = documents.withColumn(slot, slot_of(F.col(key), slots))
    return placed.join(F.broadcast(table), F.col(slot) == F.col(at)).drop(at)


def write_shards(placed: DataFrame, path: str, out: str = "shard", rows_per_file: int = 1_000_000) -> None:
    """Rows as Parquet below ``<path>/<out>=<shard>/``; a task writes what it has of a shard, in files of ``rows_per_file`` rows."""
    placed.write.option("maxRecordsPerFile", rows_per_file).partitionBy(out).parquet(path)
