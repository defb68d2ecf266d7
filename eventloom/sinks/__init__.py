from eventloom.sinks.deliver import deliver, deliver_once, md5_sender
from eventloom.sinks.http import destination_url, http_post_sender
from eventloom.sinks.export import MODES, export_results, read_export
from eventloom.sinks.partitioned import read_events, write_events

__all__ = ["MODES", "deliver", "deliver_once", "destination_url", "export_results", "http_post_sender", "md5_sender",
           "read_events", "read_export",
           "write_events"]
