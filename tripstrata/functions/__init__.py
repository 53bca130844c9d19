"""Helpers on column names and column expressions."""
