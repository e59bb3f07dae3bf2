"""veriscope: evidence retrieval and claim verification as Spark DataFrame jobs.

Layout
------
functions/  Column-level building blocks (text, vectors, lexicon scorers).
sources/    Readers and writers: landed work pages, CSV, the Parquet evidence store, JSON lines export.
operators/  DataFrame -> DataFrame operators: filters, enrichment, claims, k-NN, verification, export.
plans/      Composite jobs and the registered query catalogue (with DuckDB oracle SQL).
streaming/  Incremental ingest with Structured Streaming.
"""

__version__ = "0.1.0"
