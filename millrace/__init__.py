"""Stream and table analytics written as plain Spark jobs."""

from millrace.session import build_session, prepare, scratch

__all__ = ["build_session", "prepare", "scratch"]
