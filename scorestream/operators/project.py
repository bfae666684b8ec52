"""Projections, renames and casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def rename_all(df: DataFrame, *names: str) -> DataFrame:
    """Rename every column by position."""
    return df.toDF(*names)


def rename(df: DataFrame, old: str, new: str, strict: bool = False) -> DataFrame:
    """Rename one column.  A missing one is ignored, or refused when strict."""
    if strict and old not in df.columns:
        raise ValueError(f"no column {old!r} in {df.columns}")
    return df.withColumnRenamed(old, new)


def copy_column(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))


def columns_without(df: DataFrame, *dropped: str) -> list[str]:
    """The names left when some columns are dropped."""
    return df.drop(*dropped).columns


def cast_nullable(df: DataFrame, kinds: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast columns in one projection; a value that does not fit becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in kinds.items()})


def expand_struct(df: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """Fields of a struct column as top-level columns."""
    return df.select(*keep, f"{name}.*")


def message_text(df: DataFrame, *columns: str) -> DataFrame:
    """Message columns as strings."""
    names = columns or ("key", "value")
    return df.selectExpr(*(f"CAST({name} AS STRING) AS {name}" for name in names))
