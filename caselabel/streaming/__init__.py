"""Incremental processing of arriving case files."""
