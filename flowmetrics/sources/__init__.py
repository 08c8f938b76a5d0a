"""Readers: driver tables, adapter, landed pages, logs, table store."""
