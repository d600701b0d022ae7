from tallyline.sources.tables import purchases, stream_purchases
from tallyline.sources.topics import file_record, offset_unit, read_archive_json, read_events, source_of, topic_files
from tallyline.sources.views import ensure_table, ensure_view, read_csv_view, read_view

__all__ = [
    "ensure_table", "ensure_view", "file_record", "offset_unit", "purchases", "read_archive_json", "read_csv_view",
    "read_events", "read_view", "source_of", "stream_purchases", "topic_files",
]
