"""Class labels: codes, look-ups, correctness flags and percentages."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain
from typing import Any

from pyspark.sql import Column, functions as F


def literal_map(mapping: Mapping[Any, Any]) -> Column:
    return F.create_map(*(F.lit(item) for item in chain.from_iterable(mapping.items())))


def lookup(value: Column, mapping: Mapping[Any, Any]) -> Column:
    """Value of a small literal map; a missing key is null."""
    return F.try_element_at(literal_map(mapping), value)


def branch_code(value: Column, codes: Mapping[Any, Any], default: Any = None) -> Column:
    """The same look-up as a chain of branches, with a default."""
    branches = F
    for key, code in codes.items():
        branches = branches.when(value == F.lit(key), F.lit(code))
    return branches.otherwise(F.lit(default))


def correct_flag(
    prediction: Column, label: Column, classes: Iterable[Any] | None = None
) -> Column:
    """1 where the prediction equals the label, else 0, also for nulls.

    With ``classes`` a match counts only for the listed values.
    """
    hit = prediction == label
    if classes is not None:
        hit = hit & label.isin(list(classes))
    return F.when(hit, F.lit(1)).otherwise(F.lit(0))


def percent_text(flag: Column, digits: int = 2) -> Column:
    """Mean of a 0/1 column as a percentage with a fixed number of decimals."""
    return F.format_number(F.avg(flag) * 100, digits)
