"""rigweave: Spark-first analytics for multi-rate sensor and command recordings."""

from rigweave.session import build_session

__all__ = ["build_session"]
