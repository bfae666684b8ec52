"""Review-text classification: clean, derive features, fit, evaluate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, functions as F

from scorestream.functions.numeric import real_product, vote_interactions, with_interactions
from scorestream.operators import classifiers, metrics
from scorestream.operators.clean import above_up_to, all_between, clean_rows, drop_null_rows
from scorestream.operators.features import assemble, checked_labels, index_label, term_stages, token_stages
from scorestream.operators.sparse_tree import SparseTree
from scorestream.operators.split import is_train
from scorestream.sources.artifacts import chain_models

#: The column of filtered tokens.
TOKENS = "filtered"


@dataclass(frozen=True)
class ReviewPlan:
    """One review job.

    ``feature_set`` is ``text`` (terms only), ``votes`` (plus the counts) or
    ``full`` (plus their products): the same job with and without a feature
    group.  ``fit_on`` says whether vocabulary and label codes are learnt from
    the training rows or from all rows.  ``buckets`` counts terms by hash instead
    of by vocabulary.
    """

    key: str = "review_id"
    text: str = "text"
    target: str = "stars"
    votes: Sequence[str] = ("funny", "useful", "cool")
    feature_set: str = "full"
    classifier: str = "lr"
    tokenizer: str = "words"
    idf: bool = False
    vocab_size: int | None = 10000
    min_df: float | None = 5
    buckets: int | None = None
    max_iter: int = 100
    max_depth: int = 5
    train_percent: int = 80
    fit_on: str = "train"
    clean: bool = True
    target_range: tuple[float, float] | None = None
    vote_range: tuple[float, float] | None = None

    def prepare(self, df: DataFrame) -> DataFrame:
        """Clean and filter rows and add the products of the counts.

        Rows without a text or with a null count go here, by plain column
        tests; the products are doubles, so no count is too large.  Left to the assembler, the test would be
        on the vector, and every text would be tokenised once more to make it.
        """
        rows = clean_rows(df) if self.clean else df
        if self.target_range:
            rows = rows.where(above_up_to(self.target, *self.target_range))
        if self.vote_range:
            rows = rows.where(all_between(self.votes, *self.vote_range))
        wide = with_interactions(rows, self._products(), real_product)
        content = TOKENS if TOKENS in df.columns else self.text
        return drop_null_rows(wide, [content, *self.numeric_columns()])

    def with_tokens(self, df: DataFrame) -> DataFrame:
        """Clean rows with their tokens in place of the text.

        Stored once and then prepared, fitted and scored, they spare the jobs
        that read their rows several times all but one pass over the texts.
        Models fitted on them still take texts.
        """
        rows = clean_rows(df) if self.clean else df
        rows = drop_null_rows(rows, [self.text])
        staged = PipelineModel(stages=token_stages(self.text, self.tokenizer, TOKENS)).transform(rows)
        return staged.select(*(c for c in df.columns if c != self.text), TOKENS)

    def _products(self) -> dict[str, tuple[str, ...]]:
        return vote_interactions(*self.votes) if self.feature_set == "full" else {}

    def numeric_columns(self) -> list[str]:
        if self.feature_set == "text":
            return []
        return [*self.votes, *self._products()]

    def feature_stages(self) -> list:
        return [
            index_label(self.target, "label"),
            *token_stages(self.text, self.tokenizer, TOKENS),
            *term_stages(vocab_size=self.vocab_size, min_df=self.min_df, idf=self.idf, buckets=self.buckets),
            assemble(["term_vector", *self.numeric_columns()]),
        ]

    def classifier_stage(self):
        if self.classifier == "lr":
            return classifiers.logistic(maxIter=self.max_iter)
        if self.classifier == "dt":
            return classifiers.decision_tree(maxDepth=self.max_depth)
        if self.classifier == "nb":
            return classifiers.multinomial_bayes()
        raise ValueError(f"classifier is 'lr', 'dt' or 'nb', not {self.classifier!r}")

    def training_rows(self, prepared: DataFrame) -> DataFrame:
        return prepared.where(is_train(self.key, self.train_percent))

    def fit(self, prepared: DataFrame) -> tuple[PipelineModel, PipelineModel]:
        """Feature pipeline and classifier, apart, so that they can be stored apart."""
        train = self.training_rows(prepared)
        basis = checked_labels(prepared if self.fit_on == "all" else train, self.target)
        stages = self.feature_stages()
        needed = _needed(stages, basis)
        fitted = Pipeline(stages=needed).fit(basis)
        learnt = iter(fitted.stages)
        features = PipelineModel(stages=[next(learnt) if stage in needed else stage for stage in stages])
        vectors = fitted.transform(train).select("label", "features")
        stage = self.classifier_stage()
        if self.classifier == "dt" and classifiers.too_wide_for_trees(vectors):
            stage = SparseTree(maxDepth=self.max_depth)
        elif self.classifier == "dt":
            vectors = classifiers.dealt_for_trees(vectors, train.count())
        return features, Pipeline(stages=[stage]).fit(vectors)

    def score(self, models: Sequence[PipelineModel], df: DataFrame) -> DataFrame:
        """Key, label, prediction and whether the row was trained on."""
        scored = PipelineModel(stages=_needed(chain_models(*models).stages, df)).transform(df)
        return scored.select(
            self.key,
            "label",
            "prediction",
            F.when(is_train(self.key, self.train_percent), "train").otherwise("test").alias("part"),
        )

    def report(self, scored: DataFrame) -> DataFrame:
        """(part, metric, value) rows for train and test, from one pass."""
        return metrics.metrics_long(metrics.evaluate(scored, by=["part"]), ["part"])


def _needed(stages: Sequence, df: DataFrame) -> list:
    """The stages that rows still need: none that makes tokens where they have them."""
    if TOKENS not in df.columns:
        return list(stages)
    inputs = {s.getInputCol() for s in stages if s.hasParam("outputCol") and s.getOutputCol() == TOKENS}
    made = inputs | {TOKENS}
    return [s for s in stages if not (s.hasParam("outputCol") and s.getOutputCol() in made)]
