"""Work-item flow analytics on Spark.

Staging → star schema (calendar + conformed dimensions) → flow metrics fact →
daily flow snapshot → weekly / per-item views → Parquet export, each step a
plain DataFrame function. Sub-packages:

* ``sources``   – readers: driver tables, the work-item adapter, landed JSON
                  pages, log events, the versioned table store.
* ``functions`` – column expressions (categories, durations, calendar, JSON
                  field extraction, exact rounding).
* ``operators`` – reusable DataFrame operators (keyed merge, surrogate keys,
                  id batching, watermarks, catalog, referential checks).
* ``plans``     – the composite dataflows (dims, fact, snapshot, views,
                  export, log index, the run cycle).
* ``streaming`` – Structured Streaming ingest of landed pages.
"""

__all__ = ["session", "schemas", "params"]
