"""Readers for the files that tables are loaded from."""

from branchyard.sources.files import (
    csv_with_header,
    csv_without_header,
    parquet_files,
    temp_view,
    write_csv,
)

__all__ = ["csv_with_header", "csv_without_header", "parquet_files", "temp_view", "write_csv"]
