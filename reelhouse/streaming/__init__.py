"""Incremental and streaming forms of ingest, fact load and user history."""
