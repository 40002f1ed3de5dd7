"""Relational, layout, table and OCR operators."""
