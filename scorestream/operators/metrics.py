"""Evaluation from one confusion table.

The table has at most (classes x classes) rows per group, so one pass over the
predictions gives every metric; nothing is recomputed per metric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

RATES = ["accuracy", "weighted_f1", "error_rate"]


def confusion(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows per (group, label, prediction)."""
    return df.groupBy(
        *by, F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count("*").alias("n"))


def class_counts(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per class: support, predicted and correct, from the confusion table."""
    n, none = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)

    def side(name: str, support: Column, predicted: Column, correct: Column) -> Column:
        return F.struct(
            F.col(name).alias("class"),
            support.alias("support"),
            predicted.alias("predicted"),
            correct.alias("correct"),
        )

    sides = F.array(side("label", n, none, hit), side("prediction", none, n, none))
    return table.select(*by, F.inline(sides)).groupBy(*by, "class").agg(
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("correct").alias("correct"),
    )


def summary(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, accuracy, weighted F1 and error rate; null rates on no rows."""
    counts = class_counts(table, by)
    f1 = 2.0 * F.col("correct") / (F.col("support") + F.col("predicted"))
    total = F.sum("support")
    return (
        counts.groupBy(*by)
        .agg(
            F.coalesce(total, F.lit(0)).alias("n_rows"),
            F.try_divide(F.sum("correct").cast("double"), total).alias("accuracy"),
            F.try_divide(F.sum(F.col("support") * f1), total).alias("weighted_f1"),
        )
        .withColumn("error_rate", 1.0 - F.col("accuracy"))
    )


def evaluate(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    return summary(confusion(df, label, prediction, by), by)


def metrics_long(
    summaries: DataFrame, by: Sequence[str] = (), scale: float = 1.0
) -> DataFrame:
    """(metric, value) rows; rates are multiplied by ``scale``, counts are not."""
    scaled = summaries.select(
        *by,
        F.col("n_rows").cast("double").alias("n_rows"),
        *((F.col(c) * F.lit(scale)).alias(c) for c in RATES),
    )
    return scaled.unpivot(list(by), ["n_rows", *RATES], "metric", "value")


def batch_metrics(
    df: DataFrame,
    batch_id: int,
    label: str = "label",
    prediction: str = "prediction",
    scale: float = 1.0,
) -> DataFrame:
    """Metric rows of one micro-batch, tagged with its id."""
    rows = metrics_long(evaluate(df, label, prediction), scale=scale)
    return rows.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "metric", "value")
