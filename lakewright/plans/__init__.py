"""Flows: ingest and refresh."""
