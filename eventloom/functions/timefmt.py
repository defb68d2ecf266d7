"""Event timestamp text (the prefix of every event line) and its inverse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.common import to_col

# The event timestamp layout. The millisecond field is printed
# zero-padded (``.007``) by default; ``compat=True`` prints the bare millisecond
# number (``.7``, ``.45``) the way the original builder's pattern
# ``yyyy-MM-dd'T'HH:mm:ss.SZ`` does.
EVENT_TS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"


def event_timestamp(ts: Column | str | None = None, compat: bool = False) -> Column:
    """Timestamp text in the session time zone; ``current_timestamp()`` when no column."""
    t = F.current_timestamp() if ts is None else to_col(ts)
    if not compat:
        return F.date_format(t, EVENT_TS_PATTERN)
    millis = F.date_format(t, "SSS").cast("int").cast("string")
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss."), millis, F.date_format(t, "Z"))


def parse_event_timestamp(text: Column | str, compat: bool = False) -> Column:
    """Inverse of :func:`event_timestamp` as ``timestamp_ntz`` in the session zone; null for
    text that is no event timestamp. ``compat`` reads the bare millisecond number."""
    t = to_col(text)
    if compat:
        millis = F.regexp_extract(t, r"\.([0-9]{1,3})[+-][0-9]{4}$", 1)
        padded = F.concat(F.substring_index(t, ".", 1), F.lit("."), F.lpad(millis, 3, "0"), F.right(t, F.lit(5)))
        t = F.when(millis != "", padded)
    return F.try_to_timestamp(t, F.lit(EVENT_TS_PATTERN)).cast("timestamp_ntz")
