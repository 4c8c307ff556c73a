"""Incremental ingestion of raw sales files with Structured Streaming."""

from tillroll.streaming.ingest import clean_sales_stream, sales_stream, start_sales_ingest

__all__ = ["clean_sales_stream", "sales_stream", "start_sales_ingest"]
