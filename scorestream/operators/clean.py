"""Row cleaning: blanks to null, null removal, range filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T


def null_if_blank(name: str, kind: T.DataType) -> Column:
    """Null for NaN, for blank text and for text that reads as NaN."""
    value = F.col(name)
    if isinstance(kind, T.StringType):
        reads_nan = F.coalesce(F.isnan(value.try_cast("double")), F.lit(False))
        bad = (F.trim(value) == "") | reads_nan
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        bad = F.isnan(value)
    else:
        return value
    return F.when(~bad, value).alias(name)


def blanks_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        [
            null_if_blank(f.name, f.dataType) if f.name in chosen else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the columns (default: in any column)."""
    return df.na.drop(how="any", subset=list(columns) if columns else None)


def clean_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return drop_null_rows(blanks_to_null(df, columns), columns)


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: how many rows are null there."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return counted.unpivot([], df.columns, "column", "n_null")


def above_up_to(column: str, low: float, high: float) -> Column:
    """``low < column <= high``."""
    return (F.col(column) > low) & (F.col(column) <= high)


def all_between(columns: Sequence[str], low: float, high: float) -> Column:
    """Every column lies in the closed interval."""
    return reduce(and_, (F.col(c).between(low, high) for c in columns))
