"""Point-in-time (bitemporal) observation vintages on Spark."""

from .session import build_session

__all__ = ["build_session"]
