"""Writers for documents, report files and column values."""

from lakemark.sinks.files import write_column_values, write_documents, write_report

__all__ = ["write_column_values", "write_documents", "write_report"]
