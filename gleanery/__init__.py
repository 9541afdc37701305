"""Spark jobs for content-recommendation data: ingest, clean, resolve, match, roll up, check, sync."""
