from eventloom.sources.tables import TABLES, read_table
from eventloom.sources.text import FILE_ORDER, FILE_SEGMENT, events_from_array, lines_from_text, read_event_file

__all__ = ["FILE_ORDER", "FILE_SEGMENT", "TABLES", "events_from_array", "lines_from_text", "read_event_file",
           "read_table"]
