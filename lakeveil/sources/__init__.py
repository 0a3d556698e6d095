"""Reading and writing: CSV ingest, the Spark catalog, exports, the metadata store."""
