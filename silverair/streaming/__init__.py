"""Scheduled increments as Structured Streaming runs."""
