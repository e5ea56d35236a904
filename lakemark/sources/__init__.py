"""Readers for event collections and lake files."""

from lakemark.sources.events import EVENT_FIELDS, ingest_csv, read_events, typed_events
from lakemark.sources.lake import dataset_name, first_line, read_lines, read_table, read_texts, strip_header
from lakemark.sources.documents import json_documents, read_documents, typed_documents
from lakemark.sources.versions import drop_versions, versions

__all__ = [
    "EVENT_FIELDS",
    "dataset_name",
    "drop_versions",
    "first_line",
    "ingest_csv",
    "json_documents",
    "read_documents",
    "read_events",
    "read_lines",
    "read_table",
    "read_texts",
    "strip_header",
    "typed_documents",
    "typed_events",
    "versions",
]
