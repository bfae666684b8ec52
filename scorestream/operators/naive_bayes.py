"""Naive Bayes as aggregates and joins.

The fitted statistics are tables, so each step can be checked in SQL, and the
numbers equal those of the library estimator.  The number of classes is small
by nature (``MAX_CLASSES`` is checked) and is the only thing the driver sees.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from scorestream.operators.lookup import lookup_join
from scorestream.operators.terms import inverse_document_frequency, term_counts, vocabulary
from scorestream.workspace import materialize

MAX_CLASSES = 1000


def class_rows(train: DataFrame, label: str, *aggregates: Column) -> list:
    """Per-class statistics, most frequent class first."""
    grouped = train.where(F.col(label).isNotNull()).groupBy(label)
    rows = grouped.agg(F.count("*").alias("n"), *aggregates).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    if not rows:
        raise ValueError("no training rows with a label")
    return sorted(rows, key=lambda row: (-row["n"], str(row[label])))


def _best_class(classes: Sequence, scores: Sequence[Column]) -> Column:
    """Class with the highest score; the more frequent class wins a tie."""
    ranked = [
        F.struct(score.alias("score"), F.lit(-i).alias("rank"), F.lit(c).alias("label"))
        for i, (c, score) in enumerate(zip(classes, scores))
    ]
    return F.array_max(F.array(*ranked))["label"]


@dataclass
class TermNaiveBayes:
    """Multinomial model over vocabulary terms and optional count columns."""

    label: str
    classes: list
    priors: list[float]
    terms: DataFrame  # term, df, cf, idf, n_<class index>...
    term_total: list[float]
    size: int
    table_bytes: int
    smoothing: float
    numeric: list[str] = field(default_factory=list)
    numeric_total: list[dict[str, float]] = field(default_factory=list)

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        label: str,
        tokens: Column,
        stop_words: Sequence[str] = (),
        vocab_size: int = 10000,
        min_df: int = 5,
        smoothing: float = 1.0,
        numeric: Sequence[str] = (),
        use_idf: bool = False,
    ) -> TermNaiveBayes:
        sums = [F.sum(c).cast("double").alias(c) for c in numeric]
        lows = [F.min(c).alias(f"_min_{c}") for c in numeric]
        rows = class_rows(train, label, *sums, *lows)
        if any(row[f"_min_{c}"] is not None and row[f"_min_{c}"] < 0 for row in rows for c in numeric):
            raise ValueError("multinomial naive Bayes needs non-negative features")
        classes = [row[label] for row in rows]
        n_rows = sum(row["n"] for row in rows)
        priors = [
            math.log(row["n"] + smoothing) - math.log(n_rows + smoothing * len(rows))
            for row in rows
        ]
        parts = {f"n_{i}": F.col(label) == F.lit(c) for i, c in enumerate(classes)}
        counts = materialize(
            term_counts(train.where(F.col(label).isNotNull()), tokens, stop_words, parts), "term-counts"
        )
        weight = inverse_document_frequency(F.lit(n_rows)) if use_idf else F.lit(1.0)
        terms = materialize(
            vocabulary(counts, vocab_size, min_df)
            .withColumn("idf", weight)
            .withColumns({name: F.col(name) * F.col("idf") for name in parts}),
            "term-model",
        )
        totals = terms.agg(
            F.count("*").alias("size"),
            F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("bytes"),
            *(F.coalesce(F.sum(name), F.lit(0.0)).alias(name) for name in parts),
        ).first()
        return cls(
            label=label,
            classes=classes,
            priors=priors,
            terms=terms,
            term_total=[totals[name] for name in parts],
            size=totals["size"],
            table_bytes=totals["bytes"] + totals["size"] * 8 * (len(classes) + 4),
            smoothing=smoothing,
            numeric=list(numeric),
            numeric_total=[{c: float(row[c] or 0.0) for c in numeric} for row in rows],
        )

    def _denominator(self, i: int) -> float:
        total = self.term_total[i] + sum(self.numeric_total[i].values())
        return math.log(total + self.smoothing * (self.size + len(self.numeric)))

    def log_probability(self, i: int) -> Column:
        """Log probability of a term in class ``i``, from the term table."""
        return F.log(F.col(f"n_{i}") + F.lit(self.smoothing)) - F.lit(self._denominator(i))

    def parameters(self) -> DataFrame:
        """(term, label, log_prob) rows."""
        per_class = F.array(
            *(
                F.struct(F.lit(c).alias("label"), self.log_probability(i).alias("log_prob"))
                for i, c in enumerate(self.classes)
            )
        )
        return self.terms.select("term", F.inline(per_class))

    def best_class(self) -> Column:
        """The likeliest class, from the sums ``predict_each`` makes of a document."""
        scores = []
        for i, prior in enumerate(self.priors):
            score = F.lit(prior) + F.col(f"s_{i}") - F.col("_met") * F.lit(self._denominator(i))
            for c in self.numeric:
                weight = math.log(self.numeric_total[i][c] + self.smoothing) - self._denominator(i)
                score = score + F.coalesce(F.col(c), F.lit(0)) * F.lit(weight)
            scores.append(score)
        return _best_class(self.classes, scores)

    def without_numeric(self) -> TermNaiveBayes:
        """The model of the terms alone, from the same fit."""
        return replace(self, numeric=[], numeric_total=[{} for _ in self.classes])

    def predict(
        self, df: DataFrame, key: str, tokens: Column, keep: Sequence[str] = ()
    ) -> DataFrame:
        """Columns ``key``, ``keep`` and ``prediction``, one row per key; keys must be unique."""
        return predict_each({"prediction": self}, df, key, tokens, keep)


def predict_each(
    models: Mapping[str, TermNaiveBayes], df: DataFrame, key: str, tokens: Column, keep: Sequence[str] = ()
) -> DataFrame:
    """One column of predictions per model; the models share one term table, ``key`` is unique.

    Tokens meet the weight table once, then collapse to one row per document on
    the map side: the shuffle carries one number per class and document, and how
    much of the table the document met, since models differ in their totals.
    """
    first, *others = models.values()
    if any(other.terms is not first.terms or other.smoothing != first.smoothing for other in others):
        raise ValueError("the models come from different fits")
    sides = range(len(first.classes))
    weights = first.terms.select(
        "term", "idf", *((F.log(F.col(f"n_{i}") + F.lit(first.smoothing)) * F.col("idf")).alias(f"w_{i}") for i in sides)
    )
    numeric = list(dict.fromkeys(c for model in models.values() for c in model.numeric))
    ids = [key, *keep, *(c for c in numeric if c not in keep)]
    words = df.select(*ids, F.explode_outer(tokens).alias("term"))
    matched = lookup_join(words, weights, "term", "left", first.table_bytes)
    summed = matched.groupBy(*ids).agg(
        F.coalesce(F.sum("idf"), F.lit(0.0)).alias("_met"),
        *(F.coalesce(F.sum(f"w_{i}"), F.lit(0.0)).alias(f"s_{i}") for i in sides),
    )
    found = [model.best_class().alias(name) for name, model in models.items()]
    return summed.select(key, *keep, *found)


@dataclass
class GaussianNaiveBayes:
    """Independent normal densities per class and feature."""

    label: str
    features: list[str]
    classes: list
    priors: list[float]
    means: list[list[float]]
    variances: list[list[float]]

    @classmethod
    def fit(cls, train: DataFrame, label: str, features: Sequence[str]) -> GaussianNaiveBayes:
        moments = [
            agg for c in features for agg in (F.avg(c).alias(f"m_{c}"), F.var_pop(c).alias(f"v_{c}"))
        ]
        rows = class_rows(train, label, *moments)
        n_rows = sum(row["n"] for row in rows)
        overall = []
        for c in features:
            mean = sum(row["n"] * row[f"m_{c}"] for row in rows) / n_rows
            spread = sum(row["n"] * (row[f"v_{c}"] + (row[f"m_{c}"] - mean) ** 2) for row in rows)
            overall.append(spread / n_rows)
        floor = 1e-9 * max(overall)
        return cls(
            label=label,
            features=list(features),
            classes=[row[label] for row in rows],
            priors=[math.log(row["n"]) - math.log(n_rows) for row in rows],
            means=[[row[f"m_{c}"] for c in features] for row in rows],
            variances=[[row[f"v_{c}"] + floor for c in features] for row in rows],
        )

    def prediction(self) -> Column:
        """A plain column: no join or shuffle, so it also runs on a stream."""
        scores = []
        for prior, means, variances in zip(self.priors, self.means, self.variances):
            constant = prior - 0.5 * sum(math.log(2 * math.pi * v) for v in variances)
            score = F.lit(constant)
            for c, mean, variance in zip(self.features, means, variances):
                gap = F.col(c) - F.lit(mean)
                score = score - gap * gap / F.lit(2 * variance)
            scores.append(score)
        return _best_class(self.classes, scores)

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.prediction())

    def parameters(self, df: DataFrame) -> DataFrame:
        """(label, feature, mean, variance, log_prior) rows."""
        rows = [
            (c, f, m, v, p)
            for c, p, ms, vs in zip(self.classes, self.priors, self.means, self.variances)
            for f, m, v in zip(self.features, ms, vs)
        ]
        columns = ["label", "feature", "mean", "variance", "log_prior"]
        return df.sparkSession.createDataFrame(rows, columns)
