"""Incremental ingest, change application and the refresh run."""
