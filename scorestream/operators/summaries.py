"""Summaries that merge: cubes over pre-combined counts, sketches of distinct values and frequent items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def accuracy_cube(scored: DataFrame, label: str, prediction: str, dimensions: Sequence[str]) -> DataFrame:
    """(dimensions, level, n_rows, n_correct, accuracy) for every combination of dimensions kept or summed over.

    ``level`` is the grouping number: bit k from the right is set where the k-th
    dimension from the right is summed over, so a null that is a value stays apart
    from one that stands for all.  Rows are combined to one per full combination
    first; only these are repeated for the grouping sets.
    """
    hit = F.col(label).eqNullSafe(F.col(prediction)).cast("long")
    base = scored.groupBy(*dimensions).agg(F.count("*").alias("_n"), F.sum(hit).alias("_hit"))
    summed = base.cube(*dimensions).agg(
        F.grouping_id().alias("level"), F.sum("_n").alias("n_rows"), F.sum("_hit").alias("n_correct")
    )
    return summed.where(F.col("n_rows").isNotNull()).withColumn("accuracy", F.col("n_correct") / F.col("n_rows"))


#: HyperLogLog registers are 2**LG_SKETCH; one standard error is about 0.83 / sqrt of that.
LG_SKETCH = 12
SKETCH_ERROR = 0.83 / 2 ** (LG_SKETCH / 2)


def distinct_sketches(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by, sketch): a few kilobytes per group, however many values."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, LG_SKETCH).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, n_distinct): the sketches of coarser groups, estimated after merging."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def frequent_items(df: DataFrame, value: str, most: int, by: Sequence[str] = (), tracked: int = 1000) -> DataFrame:
    """(by, item, count): up to ``most`` frequent values per group from mergeable sketches.

    At most ``tracked`` values are followed per group; counts are exact where a group
    has fewer distinct values than that, else estimates.
    """
    top: Column = F.call_function("approx_top_k", F.col(value), F.lit(most), F.lit(tracked))
    found = df.groupBy(*by).agg(top.alias("_top")) if by else df.agg(top.alias("_top"))
    return found.select(*by, F.explode("_top").alias("_item")).select(
        *by, F.col("_item.item").alias("item"), F.col("_item.count").alias("count")
    )
