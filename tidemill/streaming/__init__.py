"""Structured Streaming jobs: login enrichment and alerts, purchase ingest, change apply."""
