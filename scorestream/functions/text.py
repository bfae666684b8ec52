"""Native text expressions.  They work the same on batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def word_tokens(text: Column, pattern: str = r"\W+") -> Column:
    """Lower-cased tokens between matches of ``pattern``, empty ones dropped.

    Equals ``RegexTokenizer(pattern="\\\\W")``: a run of separators only ever
    adds empty tokens, so splitting on the run gives the same words with fewer
    strings made.
    """
    return F.array_remove(F.split(F.lower(text), pattern), "")


def without_words(tokens: Column, words: Sequence[str]) -> Column:
    """Tokens that are not in ``words``, compared without case."""
    listed = [word.lower() for word in words]
    return F.filter(tokens, lambda token: ~F.lower(token).isin(listed))


def document_tokens(text: Column) -> Column:
    """Tokens of a document with their case: split at white space."""
    return F.array_remove(F.split(text, r"\s+"), "")


def normalize_tokens(tokens: Column, drop: str = r"[^\p{L}]", lower: bool = False) -> Column:
    """Strip the characters matching ``drop`` and remove tokens left empty."""

    def strip(token: Column) -> Column:
        cleaned = F.regexp_replace(token, drop, "")
        return F.lower(cleaned) if lower else cleaned

    return F.array_remove(F.transform(tokens, strip), "")


def finish_tokens(tokens: Column, separator: str = " ") -> Column:
    """Token array back to one string."""
    return F.array_join(tokens, separator)


def line_count(text: Column) -> Column:
    """Pieces between newlines: a trailing newline counts as one more line."""
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def path_label(path: Column, parent: str) -> Column:
    """Name of the folder right below ``parent``; empty when there is none."""
    return F.regexp_extract(path, parent + r"/([^/]+)", 1)
