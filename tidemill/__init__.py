"""Data jobs on Spark: ingestion, cleaning, matching, metrics and search as DataFrame plans."""

from tidemill.session import build_session

__all__ = ["build_session"]
