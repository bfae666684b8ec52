"""Registered queries with the SQL each is checked against."""

from scorestream.catalog import (  # noqa: F401
    bayes,
    columns,
    encoded,
    exact,
    inference,
    learn,
    scans,
    streams,
    tables,
    text,
    timed,
)
from scorestream.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
