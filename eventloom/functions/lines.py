"""Line handling for event text.

A line ends at LF, CR or CRLF. A final terminator does not start another line,
an empty text has no lines, and ``a\\n\\n`` is the two lines ``a`` and ``''``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.common import to_col

# The line terminators and the patterns built from them.
LINE_BREAK = r"\r\n|\n|\r"
FINAL_BREAK = r"(?:\r\n|\n|\r)\z"  # \z, not $: Java's $ also matches before a last line end
LF = "\n"


def split_lines(text: Column | str) -> Column:
    """``array<string>`` of the lines of ``text`` (null stays null).

    Text without a CR (the common case) drops one final LF and splits on LF with
    plain string functions; text holding a CR takes the regular-expression path.
    """
    t = to_col(text)
    lf_only = F.when(t.endswith(LF), t.substr(F.lit(1), F.length(t) - 1)).otherwise(t)
    with_cr = F.regexp_replace(t, FINAL_BREAK, "")
    return (
        F.when(t == "", F.array().cast("array<string>"))
        .when(F.instr(t, "\r") == 0, F.split(lf_only, LF, -1))
        .otherwise(F.split(with_cr, LINE_BREAK, -1))
    )


def wire_text(text: Column | str) -> Column:
    """Every line ended by exactly one LF, the last one included."""
    t = to_col(text)
    lines = split_lines(t)
    return F.when(F.size(lines) == 0, F.lit("")).otherwise(F.concat(F.array_join(lines, LF), F.lit(LF)))


def wire_event(text: Column | str) -> Column:
    """One event's text with its line ends as they are sent: CRLF and CR become LF, and a
    CR at the end is part of the line end that follows. Other text is left alone."""
    t = to_col(text)
    ended = F.replace(F.replace(F.concat(t, F.lit(LF)), F.lit("\r\n"), F.lit(LF)), F.lit("\r"), F.lit(LF))
    return F.when(F.instr(t, "\r") == 0, t).otherwise(ended.substr(F.lit(1), F.length(ended) - 1))


def array_payload(arr: Column | str) -> Column:
    """Payload of an array of events: each element followed by LF; ``''`` for an empty array."""
    a = to_col(arr)
    return F.when(F.size(a) == 0, F.lit("")).otherwise(F.concat(F.array_join(a, LF, "null"), F.lit(LF)))


def dequote(c: Column | str) -> Column:
    """Remove one pair of surrounding double quotes; other values are unchanged."""
    v = to_col(c)
    quoted = v.startswith('"') & v.endswith('"') & (F.length(v) >= 2)
    return F.when(quoted, v.substr(F.lit(2), F.length(v) - 2)).otherwise(v)


def byte_length(c: Column | str, unit: str = "bytes") -> Column:
    """Size of text in UTF-8 bytes (default) or in characters."""
    if unit == "bytes":
        return F.octet_length(to_col(c)).cast("long")
    if unit == "chars":
        return F.length(to_col(c)).cast("long")
    raise ValueError(f"unit must be 'bytes' or 'chars', got {unit!r}")
