"""Structured Streaming ingest of landed record pages."""
