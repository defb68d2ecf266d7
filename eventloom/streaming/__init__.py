from eventloom.streaming.delivery import (
    read_event_file_stream,
    read_event_stream,
    read_stream_receipts,
    start_delivery,
)

__all__ = ["read_event_file_stream", "read_event_stream", "read_stream_receipts", "start_delivery"]
