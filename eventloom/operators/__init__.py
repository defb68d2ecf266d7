from eventloom.operators.batching import (
    BLOCK_SIZE,
    MAX_PAYLOAD,
    assign_batches,
    batch_events,
    build_payloads,
    ship_totals,
    split_oversize,
    value_payloads,
)
from eventloom.operators.extract import extract_fields
from eventloom.operators.format import (
    destination_query_string,
    format_default_events,
    format_event_maps,
    format_events,
    raw_events,
    with_destination,
)
from eventloom.operators.lines import normalize_lines
from eventloom.operators.prefix import quantile_segments, running_sum
from eventloom.operators.search import dequote_columns, is_empty, page, search, search_stats, time_range

__all__ = [
    "BLOCK_SIZE", "MAX_PAYLOAD", "assign_batches", "batch_events", "build_payloads", "dequote_columns",
    "destination_query_string", "extract_fields", "format_default_events", "format_event_maps", "format_events",
    "is_empty", "normalize_lines", "page", "raw_events", "quantile_segments", "running_sum", "search", "search_stats",
    "ship_totals", "split_oversize", "time_range", "value_payloads", "with_destination",
]
