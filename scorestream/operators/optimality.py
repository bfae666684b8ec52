"""Whether a fitted linear classifier is at the minimum of its loss."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F


def logistic_slope(model: LogisticRegressionModel, rows: DataFrame, features: str, label: str) -> np.ndarray:
    """Slope of the mean multinomial loss plus penalty: one row per class, the intercept last.

    For models with several classes, an L2 penalty and no standardisation of their
    own.  One aggregate over ``rows``; its width is classes times features.
    """
    classes, width = model.numClasses, model.numFeatures
    scored = model.transform(rows).select(
        F.col(label), vector_to_array(features).alias("x"), vector_to_array("probability").alias("p")
    )
    off = [F.col("p")[k] - (F.col(label) == k).cast("double") for k in range(classes)]
    sums = [F.avg(off[k] * (F.col("x")[j] if j < width else 1.0)).alias(f"s{k}_{j}") for k in range(classes) for j in range(width + 1)]
    found = np.array(scored.agg(*sums).first(), float).reshape(classes, width + 1)
    found[:, :width] += model.getRegParam() * model.coefficientMatrix.toArray()
    return found
