"""Spark operators and plans for environmental sensor data."""

from silverair.session import build_session, configure

__all__ = ["build_session", "configure"]
