"""Readers: files, tables, streams and message topics."""

from alluvia.sources.files import read_csv_strict, read_documents, read_lines, read_table
from alluvia.sources.streams import events_from_rate, read_rate_events, read_topic, stream_messages, stream_table

__all__ = [
    "events_from_rate", "read_csv_strict", "read_documents", "read_lines", "read_rate_events", "read_table",
    "read_topic", "stream_messages", "stream_table",
]
