"""Structured Streaming ingestion (file-progress instead of a timestamp watermark)."""

from .bronze_stream import bronze_stream, ingest_available

__all__ = ["bronze_stream", "ingest_available"]
