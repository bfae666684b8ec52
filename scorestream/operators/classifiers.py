"""Library classifiers with the parameter sets the jobs use."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame

#: Bytes of binned features in one partition of a tree's input.
_TREE_BYTES = 128_000_000

#: Features above which a tree is grown on what is not zero (``sparse_tree``).
_TREE_WIDTH = 20_000


def logistic(features: str = "features", label: str = "label", **params: Any) -> LogisticRegression:
    return LogisticRegression(featuresCol=features, labelCol=label, **params)


def linear_svc(features: str = "features", label: str = "label", **params: Any) -> LinearSVC:
    """Linear support vector machine for two classes; ``one_vs_rest`` over it for more."""
    return LinearSVC(featuresCol=features, labelCol=label, **params)


def decision_tree(features: str = "features", label: str = "label", **params: Any) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, **params)


def dealt_for_trees(vectors: DataFrame, n_rows: int, features: str = "features") -> DataFrame:
    """``vectors`` in so many partitions that a task holds at most ``_TREE_BYTES`` of a tree's input.

    Trees keep a number of four bytes for every feature of every row, sparse or
    not, so a partition of short rows becomes one of very long ones.  The vectors
    are also made once and not for every pass over them.
    """
    wanted = -(-n_rows * _width(vectors, features) * 4 // _TREE_BYTES)
    if wanted < 2:
        return vectors
    return vectors.repartition(max(wanted, vectors.sparkSession.sparkContext.defaultParallelism))


def too_wide_for_trees(vectors: DataFrame, features: str = "features") -> bool:
    """Whether the library's tree would keep more than ``_TREE_WIDTH`` numbers for every row."""
    return _width(vectors, features) > _TREE_WIDTH


def _width(vectors: DataFrame, features: str) -> int:
    first = vectors.first()
    return first[features].size if first else 0


def random_forest(
    features: str = "features", label: str = "label", trees: int = 5, seed: int | None = 42, **params: Any
) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=features, labelCol=label, numTrees=trees, seed=seed, **params
    )


def gaussian_bayes(features: str = "features", label: str = "label") -> NaiveBayes:
    return NaiveBayes(featuresCol=features, labelCol=label, modelType="gaussian")


def multinomial_bayes(features: str = "features", label: str = "label", smoothing: float = 1.0) -> NaiveBayes:
    return NaiveBayes(
        featuresCol=features, labelCol=label, modelType="multinomial", smoothing=smoothing
    )


def perceptron(
    layers: Sequence[int], features: str = "features", label: str = "label", max_iter: int = 100, seed: int = 1234
) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(
        featuresCol=features, labelCol=label, layers=list(layers), maxIter=max_iter, seed=seed
    )


def one_vs_rest(
    base: Estimator, features: str = "features", label: str = "label", parallelism: int = 4
) -> OneVsRest:
    """One model per class, several fitted at a time: each is many small jobs, bound by latency."""
    return OneVsRest(classifier=base, featuresCol=features, labelCol=label, parallelism=parallelism)


def evaluator(metric: str, label: str = "label", prediction: str = "prediction") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName=metric
    )


def cross_validator(
    estimator: Estimator,
    grid: Mapping[Any, Sequence[Any]],
    metric: str,
    label: str = "label",
    folds: int = 3,
    fold_column: str | None = None,
    parallelism: int = 5,
) -> CrossValidator:
    """Grid search; the metric that picks the winner is always named."""
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(param, list(values))
    chosen = {"foldCol": fold_column} if fold_column else {}
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=builder.build(),
        evaluator=evaluator(metric, label),
        numFolds=folds,
        parallelism=parallelism,
        **chosen,
    )
