"""Spark-native personal-finance, portfolio, macro, revenue and outreach analytics."""

from ledgerlake import plans  # noqa: F401
from ledgerlake.context import MODELS, Lake, Settings
from ledgerlake.session import build_session

__all__ = ["MODELS", "Lake", "Settings", "build_session"]
