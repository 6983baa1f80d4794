"""Scans of tables, files and landed payloads."""
