"""Readers: driver parquet tables, delimited / fixed-width / XML / HTML text sources."""
