"""Readers and writers.  Only writers run jobs."""
