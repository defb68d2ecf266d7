"""Reading fields back out of event text (the inverse of :mod:`eventloom.functions.fields`).

Two readers, one per escape mode of the formatter:

* ``escape='none'``: values are unescaped, so a value ends at the first ``"``
  that is followed by the next ``delim name="`` or by the end of the text. A
  value that itself holds ``delim name="`` stays ambiguous; that is a property of
  the unescaped format, not of the reader.
* ``escape='backslash'``: a left-to-right scan of ``name="value"`` pairs with
  ``\\`` escapes; exact for every value. Field names must not hold ``=``,
  the delimiter or ``"``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.common import to_col
from eventloom.functions.fields import DEFAULT_DELIM

# The shape of a field name that may follow a delimiter.
FIELD_NAME = r"[A-Za-z_][A-Za-z0-9_.:-]*"


def _unescaped_pairs_pattern(delim: str, names: Sequence[str] = ()) -> str:
    d = re.escape(delim)
    # names that the caller gives may have any shape; the longest first, since the first match counts
    odd = sorted({n for n in names if not re.fullmatch(FIELD_NAME, n)}, key=len, reverse=True)
    name = "(?:" + "|".join([*map(_quoted, odd), FIELD_NAME]) + ")"
    return rf'(?s){d}{name}="(?:.*?)"(?={d}{name}="|\z)'


def _quoted(name: str) -> str:
    return "".join(rf"\x{{{ord(c):x}}}" for c in name)  # the same in every regular expression dialect


def _escaped_pairs_pattern(delim: str) -> str:
    d = re.escape(delim)
    return rf'(?s){d}[^={d}"]+="(?:[^"\\]++|\\.)*+"'


def unescape(v: Column) -> Column:
    return F.regexp_replace(v, r"(?s)\\(.)", "$1")


def field_pairs(raw: Column | str, delim: str = DEFAULT_DELIM, escape: str = "backslash", names: Sequence[str] = ()) -> Column:
    """All ``delim name="value"`` pairs of event text, in order, as
    ``array<struct<key, value>>`` (repeated names kept).

    One left-to-right regex pass finds the whole pairs; names and values are then
    cut out with plain string functions. In unescaped text a value ends where a field name
    can begin: ``names`` adds those that don't have the usual shape (``user id``, ``2nd``).
    """
    if escape not in ("none", "backslash"):
        raise ValueError(f"escape must be 'none' or 'backslash', got {escape!r}")
    pat = _escaped_pairs_pattern(delim) if escape == "backslash" else _unescaped_pairs_pattern(delim, names)
    d = len(delim)

    def entry(p: Column) -> Column:
        name = F.substring_index(p.substr(F.lit(d + 1), F.length(p)), '="', 1)
        n = F.length(name)
        value = F.substring(p, n + d + 3, F.length(p) - n - d - 3)
        if escape == "backslash":
            value = unescape(value)
        return F.struct(name.alias("key"), value.alias("value"))

    return F.transform(F.regexp_extract_all(to_col(raw), F.lit(pat), 0), entry)


def first_value(pairs: Column | str, name: str) -> Column:
    """The value of the first pair called ``name`` in a :func:`field_pairs` array
    (null when absent). Refer to a projected pairs column, not the expression,
    so the text is scanned once."""
    p = to_col(pairs)
    pos = F.array_position(p["key"], F.lit(name))
    return F.when(pos > 0, F.element_at(p["value"], pos.cast("int")))


def fields_map(raw: Column | str, delim: str = DEFAULT_DELIM, escape: str = "backslash") -> Column:
    """All fields of event text as ``map<string,string>``; the first of a repeated name wins."""
    # fold left to right so a repeated name keeps its first value; the pairs
    # array is evaluated once (a lambda referring back to it would re-run the scan)
    empty = F.create_map().cast("map<string,string>")
    return F.aggregate(
        field_pairs(raw, delim, escape),
        empty,
        lambda acc, e: F.when(F.map_contains_key(acc, e["key"]), acc).otherwise(
            F.map_concat(acc, F.create_map(e["key"], e["value"]))),
    )


def extract_field(raw: Column | str, name: str, delim: str = DEFAULT_DELIM, escape: str = "none") -> Column:
    """The value of the first field called ``name`` (null when absent)."""
    return F.element_at(fields_map(raw, delim, escape), F.lit(name))


def event_time_text(raw: Column | str, delim: str = DEFAULT_DELIM) -> Column:
    """The timestamp prefix: everything before the first delimiter."""
    return F.substring_index(to_col(raw), delim, 1)
