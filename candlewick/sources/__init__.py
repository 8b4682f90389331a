"""Readers and ingest: candle pages, landed files, raw table, test-data adapter."""
