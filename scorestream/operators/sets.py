"""Unions and bounded previews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union_all(*parts: DataFrame) -> DataFrame:
    """Bag union by position, duplicates kept."""
    return reduce(DataFrame.unionAll, parts)


def top_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows, for looking at a table."""
    return df.limit(n)


def row_and_column_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )
