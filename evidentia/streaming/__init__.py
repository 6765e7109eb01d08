"""Incremental and streaming forms."""
