"""Field extraction: event text back to typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.extract import event_time_text, field_pairs, first_value
from eventloom.functions.fields import DEFAULT_DELIM, NULL_TEXT
from eventloom.functions.timefmt import parse_event_timestamp

#: A discovered field becomes a column; more names than this are an error, not a wide table.
MAX_FIELDS = 2_000

# How Spark writes values of the types that are tried: text of another shape isn't given back by them. It is
# not cast, as a cast that fails costs an exception.
_SHAPES = {
    "bigint": r"\A-?[0-9]{1,19}\z",
    "double": r"\A(?:-?[0-9]+\.[0-9]+(?:E-?[0-9]+)?|NaN|-?Infinity)\z",
    "boolean": r"\A(?:true|false)\z",
}


def _written_as(value: Column, kind: str) -> Column:
    return value.rlike(_SHAPES[kind])


def extract_fields(
    df: DataFrame,
    names: Sequence[str],
    raw: str = "raw",
    delim: str = DEFAULT_DELIM,
    escape: str = "none",
    time_out: str | None = "_time",
    keep: Sequence[str] = (),
    compat: bool = False,
) -> DataFrame:
    """One string column per name (null when the event lacks it), plus the parsed
    event time in ``time_out`` (null for a line without a stamp; ``compat`` as the
    formatter had it). All names come from one pass over the text
    (:func:`eventloom.functions.extract.field_pairs`) and may have any shape."""
    cols = [F.col(k) for k in keep]
    if time_out:
        cols.append(parse_event_timestamp(event_time_text(raw, delim), compat).alias(time_out))
    # project the pairs once; looking names up in a second projection keeps
    # Catalyst from inlining (and re-running) the scan once per name
    with_pairs = df.select(*cols, field_pairs(raw, delim, escape, names).alias("_pairs"))
    return with_pairs.select(*[c for c in with_pairs.columns if c != "_pairs"],
                             *[first_value("_pairs", n).alias(n) for n in names])


def discover_fields(df: DataFrame, raw: str = "raw", delim: str = DEFAULT_DELIM, escape: str = "backslash") -> DataFrame:
    """(name, n_events, type) of every field in event text, one aggregation over the events.

    The type is the first of ``bigint``, ``double``, ``boolean`` that gives back every value of the field as it
    is written, else ``string``; ``null`` (how a null is written) fits any. A name that an event repeats counts once.
    """
    # one pass over the text; rows are projected once so that the scan isn't run again for each use
    found = df.select(field_pairs(raw, delim, escape).alias("_pairs")).select("_pairs", F.array_distinct("_pairs.key").alias("_names"))
    entry = lambda name, value, first: F.struct(name.alias("name"), value.alias("value"), F.lit(first).alias("first"))
    nothing = F.lit(None).cast("string")
    # where an event repeats a name, each of its names has an entry without a value to be counted by: no shuffle of events
    once = F.transform("_pairs", lambda p: entry(p["key"], p["value"], True))
    again = F.concat(F.transform("_pairs", lambda p: entry(p["key"], p["value"], False)), F.transform("_names", lambda n: entry(n, nothing, True)))
    entries = found.select(F.explode(F.when(F.size("_names") == F.size("_pairs"), once).otherwise(again)).alias("p"))
    value = F.when(F.col("p.value") != F.lit(NULL_TEXT), F.col("p.value"))
    fits = lambda t: F.coalesce(F.when(_written_as(value, t), value.try_cast(t).cast("string") == value), value.isNull())
    types = entries.groupBy(F.col("p.name").alias("name")).agg(
        F.count_if("p.first").alias("n_events"), *[F.bool_and(fits(t)).alias(t) for t in _SHAPES], F.count(value).alias("_values"))
    kind = F.when(F.col("_values") == 0, "string")
    for t in _SHAPES:
        kind = kind.when(F.col(t), t)
    return types.select("name", "n_events", kind.otherwise("string").alias("type"))


def extract_discovered(df: DataFrame, raw: str = "raw", delim: str = DEFAULT_DELIM, escape: str = "backslash",
                       keep: Sequence[str] = (), time_out: str | None = "_time", compat: bool = False) -> DataFrame:
    """:func:`extract_fields` with the fields that the events have, by name, in the types found by :func:`discover_fields`."""
    found = discover_fields(df, raw, delim, escape).limit(MAX_FIELDS + 1).collect()
    if len(found) > MAX_FIELDS:
        raise ValueError(f"over {MAX_FIELDS} field names: choose some and use extract_fields")
    types = {r["name"]: r["type"] for r in sorted(found, key=lambda r: r["name"])}
    rows = extract_fields(df, list(types), raw, delim, escape, time_out, keep, compat)
    return rows.select(*[c for c in rows.columns if c not in types],
                       *[F.when(F.col(f"`{n}`") != F.lit(NULL_TEXT), F.col(f"`{n}`")).try_cast(t).alias(n) for n, t in types.items()])
