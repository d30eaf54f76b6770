"""Readers and writers: CSV/Parquet sources, snapshots, sinks."""
