"""Column-expression builders (all JVM-side built-ins; no Python per row)."""

from eventloom.functions.extract import event_time_text, extract_field, fields_map
from eventloom.functions.fields import (
    DEFAULT_DELIM,
    NULL_TEXT,
    columns_map,
    event_text,
    map_event_text,
    value_text,
)
from eventloom.functions.lines import array_payload, byte_length, dequote, split_lines, wire_text
from eventloom.functions.timefmt import EVENT_TS_PATTERN, event_timestamp, parse_event_timestamp
from eventloom.functions.timerange import DEFAULT_EARLIEST, DEFAULT_LATEST, resolve_time

__all__ = [
    "DEFAULT_DELIM",
    "DEFAULT_EARLIEST",
    "DEFAULT_LATEST",
    "EVENT_TS_PATTERN",
    "NULL_TEXT",
    "array_payload",
    "byte_length",
    "columns_map",
    "dequote",
    "event_text",
    "event_time_text",
    "event_timestamp",
    "extract_field",
    "fields_map",
    "map_event_text",
    "parse_event_timestamp",
    "resolve_time",
    "split_lines",
    "value_text",
    "wire_text",
]
