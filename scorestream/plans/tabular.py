"""Classification of numeric rows: features, optional scaling, fit, evaluate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, functions as F

from scorestream.operators import classifiers, metrics
from scorestream.operators.features import assemble, checked_labels, index_label, principal_components, scale, unindex_label
from scorestream.operators.split import fold_column, is_train


@dataclass(frozen=True)
class TabularPlan:
    """One job over numeric columns.

    ``scaling`` is None, ``std`` (unit deviation), ``mean`` (centred) or
    ``pca`` (centred, then ``components`` principal components).
    """

    key: str
    columns: Sequence[str]
    target: str
    classifier: str = "lr"
    scaling: str | None = None
    components: int = 3
    train_percent: int = 80
    max_iter: int = 10
    reg: float = 0.3
    trees: int = 5
    seed: int = 42

    def feature_stages(self) -> tuple[list, str]:
        stages: list = [assemble(self.columns)]
        if self.scaling is None:
            return stages, "features"
        if self.scaling == "std":
            return [*stages, scale()], "scaled"
        if self.scaling not in ("mean", "pca"):
            raise ValueError(f"unknown scaling {self.scaling!r}")
        stages.append(scale(std=False, mean=True))
        if self.scaling == "mean":
            return stages, "scaled"
        return [*stages, principal_components(self.components, "scaled")], "components"

    def classifier_stage(self, features: str, n_classes: int) -> Any:
        if self.classifier == "lr":
            return classifiers.logistic(features, maxIter=self.max_iter, regParam=self.reg)
        if self.classifier == "dt":
            return classifiers.decision_tree(features)
        if self.classifier == "rf":
            return classifiers.random_forest(features, trees=self.trees, seed=self.seed)
        if self.classifier == "gnb":
            return classifiers.gaussian_bayes(features)
        if self.classifier == "mlp":
            width = self.components if self.scaling == "pca" else len(self.columns)
            return classifiers.perceptron(
                [width, width + 1, n_classes], features, max_iter=self.max_iter
            )
        if self.classifier == "ovr":
            base = classifiers.logistic(features, maxIter=self.max_iter, regParam=self.reg)
            return classifiers.one_vs_rest(base, features)
        if self.classifier == "svc":
            base = classifiers.linear_svc(features, maxIter=self.max_iter, regParam=self.reg)
            return classifiers.one_vs_rest(base, features)
        raise ValueError(f"unknown classifier {self.classifier!r}")

    def _indexed(self, df: DataFrame):
        """Label codes are learnt once and used by every stage that needs them."""
        return index_label(self.target).fit(checked_labels(df.select(self.target), self.target))

    def fit(self, df: DataFrame) -> PipelineModel:
        train = df.where(is_train(self.key, self.train_percent))
        indexer = self._indexed(train)
        stages, features = self.feature_stages()
        model = self.classifier_stage(features, len(indexer.labels))
        back = unindex_label([*indexer.labels, "unknown"])
        return Pipeline(stages=[indexer, *stages, model, back]).fit(train)

    def tune(self, df: DataFrame, regs: Sequence[float], folds: int = 3, metric: str = "accuracy") -> CrossValidatorModel:
        """Cross-validated regularisation of the (one-vs-rest) logistic model."""
        if self.classifier not in ("lr", "ovr"):
            raise ValueError("only lr and ovr are tuned")
        train = fold_column(df.where(is_train(self.key, self.train_percent)), self.key, folds)
        indexer = self._indexed(train)
        stages, features = self.feature_stages()
        base = classifiers.logistic(features, maxIter=self.max_iter, regParam=self.reg)
        top = classifiers.one_vs_rest(base, features) if self.classifier == "ovr" else base
        search = classifiers.cross_validator(
            Pipeline(stages=[indexer, *stages, top]),
            {base.regParam: regs},
            metric,
            folds=folds,
            fold_column="fold",
        )
        # The folds are read once per candidate.
        cached = train.select(self.key, self.target, *self.columns, "fold").persist()
        try:
            return search.fit(cached)
        finally:
            cached.unpersist()

    def score(self, model: PipelineModel, df: DataFrame) -> DataFrame:
        part = F.when(is_train(self.key, self.train_percent), "train").otherwise("test")
        kept = ["label", "prediction"]
        scored = model.transform(df)
        if "predicted_label" in scored.columns:
            kept.append("predicted_label")
        return scored.select(self.key, self.target, *kept, part.alias("part"))

    def report(self, scored: DataFrame) -> DataFrame:
        return metrics.metrics_long(metrics.evaluate(scored, by=["part"]), ["part"])
