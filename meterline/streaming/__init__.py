"""Structured Streaming ingest of Parquet files into the raw layer."""

from meterline.streaming.ingest import IngestResult, ingest, read_file_stream, read_ingested, with_lineage
from meterline.streaming.schema_log import Evolution, read_log, schema_at

__all__ = ["Evolution", "IngestResult", "ingest", "read_file_stream", "read_ingested", "read_log", "schema_at", "with_lineage"]
