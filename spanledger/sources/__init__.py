"""Readers, writers, catalog metadata and the shared scratch folder."""
