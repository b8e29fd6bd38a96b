"""skillstream: job-posting intelligence as native Spark DataFrame operators.

Layout
------
functions/  column-level building blocks (dictionary patterns, tagging, scoring)
operators/  DataFrame -> DataFrame operators (enrichment, metrics, alert matching)
sources/    readers, writers and JSON codecs (files, tables, message envelopes)
streaming/  Structured Streaming jobs (continuous ingest, incremental alerts)
plans/      the named query catalogue used by the entry points and the bench
"""

__version__ = "0.1.0"
