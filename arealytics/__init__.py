"""arealytics: place-based use analytics on Spark DataFrames."""

from arealytics.session import build_session, pin

__all__ = ["build_session", "pin"]
