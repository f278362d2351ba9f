"""Incremental landing of documents."""
