"""Resumable incremental ingestion on Structured Streaming."""
