"""Prepare, classify and score tabular, text and binary data on Spark."""

from scorestream.session import build_session

__all__ = ["build_session"]
