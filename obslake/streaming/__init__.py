"""Incremental Bronze ingest with Structured Streaming (bounded ``availableNow`` runs)."""
