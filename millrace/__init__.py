"""Data-pipeline operators for Spark: ingestion, modelling, quality, lake tables, retrieval, streams."""
