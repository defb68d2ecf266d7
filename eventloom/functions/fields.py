"""Building ``name="value"`` event text as one JVM-side ``concat`` per row.

Rules kept from the original event builder:

* a field is ``delim + name + '="' + value + '"'`` appended after the timestamp;
* a null value is written as the text ``null``;
* duplicate names are allowed (fields are an ordered list, not a map);
* with ``escape='none'`` double quotes inside values are written as is.
  ``escape='backslash'`` writes ``\\`` and ``"`` as ``\\\\`` and ``\\"`` so that
  :mod:`eventloom.functions.extract` can read every value back exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.common import to_col
from eventloom.functions.timefmt import event_timestamp

# Default field delimiter and the text written for a null value.
DEFAULT_DELIM = "|"
NULL_TEXT = "null"
ESCAPES = ("none", "backslash")

FieldSpec = Sequence[tuple[str, Column | str]] | Sequence[str]


def _check_escape(escape: str) -> None:
    if escape not in ESCAPES:
        raise ValueError(f"escape must be one of {ESCAPES}, got {escape!r}")


def value_text(value: Column | str, escape: str = "none") -> Column:
    """A field value as event text: cast to string, null -> ``null``, optional escaping."""
    _check_escape(escape)
    v = F.coalesce(to_col(value).cast("string"), F.lit(NULL_TEXT))
    return _escaped(v) if escape == "backslash" else v


def _escaped(v: Column) -> Column:
    # backslashes first, then quotes: \ -> \\ and " -> \"
    return F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def normalize_fields(fields: FieldSpec) -> list[tuple[str, Column]]:
    out: list[tuple[str, Column]] = []
    for f in fields:
        if isinstance(f, str):
            out.append((f, F.col(f)))
        else:
            name, c = f
            out.append((name, to_col(c)))
    return out


def field_parts(fields: FieldSpec, delim: str = DEFAULT_DELIM, escape: str = "none") -> list[Column]:
    """The concat arguments for a list of fields (literal name part, value, closing quote)."""
    parts: list[Column] = []
    for name, c in normalize_fields(fields):
        parts += [F.lit(f'{delim}{name}="'), value_text(c, escape), F.lit('"')]
    return parts


def event_text(
    fields: FieldSpec,
    ts: Column | str | None = None,
    delim: str = DEFAULT_DELIM,
    escape: str = "none",
    compat: bool = False,
    with_timestamp: bool = True,
) -> Column:
    """Timestamp, then ``delim name="value"`` for each field, in order."""
    head: list[Column] = [_stamp(ts, compat)] if with_timestamp else []
    parts = head + field_parts(fields, delim, escape)
    return F.concat(*parts) if parts else F.lit("")


def _stamp(ts: Column | str | None, compat: bool) -> Column:
    return F.coalesce(event_timestamp(ts, compat), F.lit(NULL_TEXT))


# Fixed value: width of the default timestamp text for years 1000-9999.
TS_TEXT_WIDTH = 28


def event_size(
    fields: FieldSpec,
    ts: Column | str | None = None,
    delim: str = DEFAULT_DELIM,
    escape: str = "none",
    compat: bool = False,
    with_timestamp: bool = True,
    unit: str = "bytes",
    wire: bool = False,
) -> Column:
    """Size of :func:`event_text` without building the text: the literal parts'
    sizes plus each value's size (the timestamp has a fixed width in the
    default layout). With ``wire``, of the text as it is sent, where CRLF is one LF
    (a value is always followed by its quote, so none spans two parts)."""
    measure = F.octet_length if unit == "bytes" else F.length
    normalized = normalize_fields(fields)
    const = sum(len(f'{delim}{name}="'.encode() if unit == "bytes" else f'{delim}{name}="') + 1
                for name, _ in normalized)
    total: Column = F.lit(const)
    if with_timestamp:
        text = _stamp(ts, compat)
        if compat or ts is None:
            total = total + measure(text)
        else:
            t = to_col(ts)
            total = total + F.when(F.year(t).between(1000, 9999), F.lit(TS_TEXT_WIDTH)).otherwise(measure(text))
    for _, c in normalized:
        value = value_text(c, escape)
        total = total + measure(F.replace(value, F.lit("\r\n"), F.lit("\n")) if wire else value)
    return total.cast("long")


def map_event_text(
    m: Column | str,
    ts: Column | str | None = None,
    delim: str = DEFAULT_DELIM,
    escape: str = "none",
    compat: bool = False,
) -> Column:
    """Timestamp, then one ``delim key="value"`` per map entry in map order."""
    _check_escape(escape)

    def entry(e: Column) -> Column:
        v = F.coalesce(e["value"].cast("string"), F.lit(NULL_TEXT))
        if escape == "backslash":
            v = _escaped(v)
        return F.concat(F.lit(delim), e["key"].cast("string"), F.lit('="'), v, F.lit('"'))

    body = F.array_join(F.transform(F.map_entries(to_col(m)), entry), "")
    return F.concat(_stamp(ts, compat), F.coalesce(body, F.lit("")))


def columns_map(names: Iterable[str]) -> Column:
    """An ordered ``map<string,string>`` of the named columns (names must be distinct)."""
    kv: list[Column] = []
    for n in names:
        kv += [F.lit(n), F.col(n).cast("string")]
    return F.create_map(*kv)
