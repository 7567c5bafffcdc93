"""Incremental (streaming) versions of the case-touch aggregates."""
