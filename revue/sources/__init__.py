"""Sources and sinks."""

from revue.sources.fixtures import raw_csv_frame, raw_reviews, table
from revue.sources.io import (checked_load, csv_round_trip, export_table, parquet_round_trip,
                              raw_from_csv, read_raw_csv, require_columns, write_csv, write_parquet)

__all__ = ["checked_load", "csv_round_trip", "export_table", "parquet_round_trip", "raw_csv_frame",
           "raw_from_csv", "raw_reviews", "read_raw_csv", "require_columns", "table", "write_csv",
           "write_parquet"]
