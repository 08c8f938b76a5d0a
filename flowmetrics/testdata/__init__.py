"""Source responses derived from the driver's tables, for registered queries and tests.

The HTTP client of the source is not rebuilt. These builders turn staging rows
and tables into the documents it would land, awkward ones among them; the
readers under test are in ``sources.landing`` and ``streaming.ingest``.
"""
