"""Paging by continuation: the next page starts behind the last row, and not at a row number.

A page's token holds the order values of its last row and how many rows with exactly these
values were shown. The next page is the rows from there on (a condition that reaches the
scan), less those, so no page numbers or sorts what earlier pages showed.

Many pages are taken in runs: one call numbers the rows behind the token and gives the next
``pages`` pages with the token of the last one, so that a long result takes a few calls
(with runs that grow, by the logarithm of its pages) and not one job and one plan a page.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType, VariantType

from eventloom.operators.search import TOPK_ROWS, full_order, page

#: A run of pages up to this many rows is a top-k (each task keeps so many); a longer one is numbered in two levels.
RUN_TOPK_ROWS = 10_000


@dataclass(frozen=True)
class Page:
    """A page's rows, in order, and the token of the next one (None: this is the last)."""

    rows: DataFrame
    token: str | None


def _seek(df: DataFrame, order: Sequence[str], values: Sequence[str | None]) -> Column:
    """Rows not before the key of ``values``, nulls first as in the sort."""
    condition = F.lit(True)
    for c, v in reversed(list(zip(order, values))):
        col, kind = F.col(f"`{c}`"), df.schema[c].dataType
        if v is None:
            condition = col.isNotNull() | condition
        else:
            lit = F.lit(v).cast(kind)
            condition = (col > lit) | ((col == lit) & condition)
    first, v = order[0], values[0]
    # said once more without the alternatives, for the scan
    return condition if v is None else (F.col(f"`{first}`") >= F.lit(v).cast(df.schema[first].dataType)) & condition


def next_page(df: DataFrame, order_by: Sequence[str], count: int, token: str | None = None,
              pages: int = 1, number: str | None = None) -> Page:
    """The page of ``count`` rows behind ``token`` (None: the first page), in ``order_by``, ties by all other columns.

    Pages taken one after the other show each row once, as long as ``df`` has the same rows.
    ``count`` is at most ``TOPK_ROWS``; order columns must be of atomic types.
    ``pages`` takes so many pages at once, and the token is that of the last of them; ``number`` names
    a column for the page's number in this call, from 0.
    """
    if not 0 < count <= TOPK_ROWS:
        raise ValueError(f"count must be 1 to {TOPK_ROWS}")
    if pages < 1:
        raise ValueError("pages must be positive")
    order = full_order(df, order_by)
    for c in order:
        if isinstance(df.schema[c].dataType, (ArrayType, MapType, StructType, VariantType, BinaryType)):
            raise ValueError(f"rows can't be continued by {c}, which is no atomic value")
    said = json.loads(token) if token else None
    if said and said["order"] != order:
        raise ValueError("the token belongs to another order")
    rest = df if said is None else df.where(_seek(df, order, said["values"]))
    skip = said["shown"] if said else 0
    rows = _run(rest, order, skip, count, pages, number)
    key = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)])
    groups = rows.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    last = groups.agg(F.sum("n").alias("n"), F.max(F.struct("key", F.col("n").alias("shown"))).alias("last")).select(
        "n", "last.shown", *[F.col(f"last.key.k{i}").cast("string").alias(f"k{i}") for i in range(len(order))]).first()
    if (last["n"] or 0) < count * pages:
        return Page(rows, None)
    values = [last[f"k{i}"] for i in range(len(order))]
    shown = last["shown"] + (skip if said and said["values"] == values else 0)
    return Page(rows, json.dumps({"order": order, "values": values, "shown": shown}))


def _run(rest: DataFrame, order: Sequence[str], skip: int, count: int, pages: int, number: str | None) -> DataFrame:
    """``pages`` pages of ``rest`` behind its first ``skip`` rows, in order."""
    by = [F.col(f"`{c}`") for c in order]
    wanted = count * pages
    if pages > 1 and skip + wanted > RUN_TOPK_ROWS:
        row = "_page_row"
        taken = page(rest, order, skip, wanted, number=row)
        of_page = F.floor((F.col(row) - 1 - skip) / count).cast("long")
        return (taken.withColumn(number, of_page) if number else taken).drop(row)
    ordered = rest.orderBy(*by)
    rows = (ordered.offset(skip) if skip else ordered).limit(wanted)
    if not number:
        return rows
    if pages == 1:
        return rows.withColumn(number, F.lit(0).cast("long"))
    # a top-k is in one task already
    return rows.withColumn(number, F.floor((F.row_number().over(Window.orderBy(*by)) - 1) / count).cast("long"))
