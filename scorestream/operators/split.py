"""Train and held-out splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def hash_bucket(key: str | Column, buckets: int = 100) -> Column:
    """Bucket of a row from the MD5 of its key.

    Depends on the key alone: not on partitioning, order or retries, so a lost
    executor cannot move a row from one side of a split to the other.
    """
    column = F.col(key) if isinstance(key, str) else key
    head = F.substring(F.md5(column.cast("string")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets))


def is_train(key: str | Column, train_percent: int = 80) -> Column:
    return hash_bucket(key) < train_percent


def hash_split(
    df: DataFrame, key: str, train_percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Train and held-out rows by key hash."""
    train = is_train(key, train_percent)
    return df.where(train), df.where(~train)


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int | None = None
) -> list[DataFrame]:
    """Seeded or unseeded row sampling."""
    return df.randomSplit(list(weights), seed)


def fold_column(df: DataFrame, key: str, folds: int, name: str = "fold") -> DataFrame:
    """Cross-validation fold of each row, from its key."""
    salted = F.concat(F.lit("fold-"), F.col(key).cast("string"))
    return df.withColumn(name, hash_bucket(salted, folds).cast("int"))
