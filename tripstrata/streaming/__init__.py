"""Structured Streaming versions of the layer flows."""
