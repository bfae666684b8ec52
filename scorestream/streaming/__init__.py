"""Operators for unbounded frames."""
