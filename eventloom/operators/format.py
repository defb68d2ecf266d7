"""Formatting operators: rows of any table or stream -> event text (``raw``) and destination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.common import lit_or_col, to_col
from eventloom.functions.fields import (
    DEFAULT_DELIM,
    FieldSpec,
    columns_map,
    event_text,
    map_event_text,
)

# Destination metadata names, in the order they are added to a
# request's query string.
DESTINATION = ("index", "source", "sourcetype")
QUERY_STRING_ORDER = ("source", "sourcetype", "index")


def format_events(
    df: DataFrame,
    fields: FieldSpec | None = None,
    ts: Column | str | None | bool = "ts",
    delim: str = DEFAULT_DELIM,
    escape: str = "none",
    compat: bool = False,
    out: str = "raw",
    keep: bool = True,
) -> DataFrame:
    """Add ``out`` = timestamp + ``delim name="value"`` per field.

    ``fields`` defaults to every column except ``ts``. ``ts=None`` stamps the
    current time (one value per query), as a builder made at send time does;
    ``ts=False`` writes no timestamp (the text starts with the first delimiter).
    ``keep=False`` returns only ``out``.
    """
    ts_name = ts if isinstance(ts, str) else None
    if fields is None:
        fields = [c for c in df.columns if c != ts_name]
    stamp = ts is not False
    raw = event_text(fields, ts if stamp else None, delim, escape, compat, with_timestamp=stamp).alias(out)
    return df.select(*[c for c in df.columns if c != out], raw) if keep else df.select(raw)


def format_event_maps(
    df: DataFrame,
    m: Column | str,
    ts: Column | str | None = "ts",
    delim: str = DEFAULT_DELIM,
    escape: str = "none",
    compat: bool = False,
    out: str = "raw",
) -> DataFrame:
    """Add ``out`` from a ``map`` column, one field per entry in map order."""
    return df.select(*[c for c in df.columns if c != out], map_event_text(m, ts, delim, escape, compat).alias(out))


def format_default_events(df: DataFrame, names: list[str] | None = None, ts: Column | str | None = "ts",
                          out: str = "raw") -> DataFrame:
    """A map of the named columns sent as one event with the default ``|`` delimiter."""
    ts_name = ts if isinstance(ts, str) else None
    names = names or [c for c in df.columns if c != ts_name]
    return df.select(*[c for c in df.columns if c != out],
                     map_event_text(columns_map(names), ts, DEFAULT_DELIM).alias(out))


def _override(value, default) -> Column:
    v = lit_or_col(value) if value is not None else F.lit(None).cast("string")
    d = lit_or_col(default) if default is not None else F.lit(None).cast("string")
    return F.coalesce(F.nullif(v.cast("string"), F.lit("")), d.cast("string"))


def with_destination(
    df: DataFrame,
    index=None,
    source=None,
    sourcetype=None,
    defaults: dict | None = None,
) -> DataFrame:
    """Add ``index``, ``source``, ``sourcetype``: the override where it is not null or
    empty, else the default (``None`` = the collector's own default).

    Overrides and defaults may be literals or columns, so one job can route rows
    to many destinations. These columns key batching, delivery and sinks.
    """
    defaults = defaults or {}
    given = {"index": index, "source": source, "sourcetype": sourcetype}
    cols = [_override(given[k], defaults.get(k)).alias(k) for k in DESTINATION]
    return df.select(*[c for c in df.columns if c not in DESTINATION], *cols)


def destination_query_string(prefix: str = "?") -> Column:
    """``?source=..&sourcetype=..&index=..`` for the non-empty destination columns; ``''`` if none."""
    parts = [F.when(F.col(k) != "", F.concat(F.lit(f"{k}="), F.col(k))) for k in QUERY_STRING_ORDER]
    body = F.concat_ws("&", *parts)
    return F.when(body == "", F.lit("")).otherwise(F.concat(F.lit(prefix), body))


def raw_events(df: DataFrame, raw: Column | str = "raw") -> DataFrame:
    """Ready event strings pass through unchanged as ``raw`` (the raw-event path)."""
    if isinstance(raw, str) and raw == "raw":
        return df
    return df.select(*[c for c in df.columns if c != "raw"], to_col(raw).cast("string").alias("raw"))
