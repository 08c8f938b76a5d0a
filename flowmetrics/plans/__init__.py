"""Composite dataflows: dimensions, fact, snapshot, views, export, logs."""
