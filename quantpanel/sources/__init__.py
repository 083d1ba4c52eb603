"""Readers, writers, ingestion and calendar tables."""
