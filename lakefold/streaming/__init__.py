"""Incremental landing with Structured Streaming (exactly-once file ingestion)."""

from lakefold.streaming.landing import land_documents, land_delimited  # noqa: F401
