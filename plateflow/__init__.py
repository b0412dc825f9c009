"""Set-based Spark operators for the data work around plate-imaging analyses."""

from plateflow.session import build_session

__all__ = ["build_session"]
