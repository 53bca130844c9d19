"""Cleaning rules and the layer-to-layer flows."""
