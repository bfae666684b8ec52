"""Arithmetic that stays null where a plain operator would fail."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


_INT_LOW, _INT_HIGH = -(2**31), 2**31 - 1


def _int_product(left: Column, right: Column) -> Column:
    wide = left.cast("bigint") * right.cast("bigint")
    return F.when(wide.between(_INT_LOW, _INT_HIGH), wide.cast("int"))


def product(*columns: Column) -> Column:
    """Product of 32-bit integers; null on a null factor and on overflow.

    Two such factors always fit 64 bits, so a range test settles overflow.
    ``try_multiply`` gives the same values, but raises and catches an exception
    for every overflowing row.
    """
    return reduce(_int_product, columns)


def real_product(*columns: Column) -> Column:
    """Product in double precision: null on a null factor only, of whatever size."""
    return reduce(lambda left, right: left * right, (c.cast("double") for c in columns))


def with_interactions(
    df: DataFrame, terms: Mapping[str, Sequence[str]], combine: Callable[..., Column] = product
) -> DataFrame:
    """Add one product column per entry: output name -> factor columns."""
    return df.withColumns(
        {name: combine(*(F.col(c) for c in factors)) for name, factors in terms.items()}
    )


def vote_interactions(first: str, second: str, third: str) -> dict[str, tuple[str, ...]]:
    """The three pairwise products and the triple product of three counts."""
    return {
        f"{first}_{second}": (first, second),
        f"{first}_{third}": (first, third),
        f"{third}_{second}": (third, second),
        f"{first}_{second}_{third}": (first, third, second),
    }
