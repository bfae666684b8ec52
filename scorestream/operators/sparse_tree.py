"""A classification tree over sparse vectors; its passes cost what is not zero."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window, functions as F

from scorestream.workspace import materialize

#: An impurity below this is none.
_NONE = 2.0**-52

#: Feature and threshold of a node; what is at most the threshold goes left.
Split = tuple[int, float]


class _TreeParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, HasProbabilityCol):
    """Columns with the library's names."""


class SparseTree(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """The library's classification tree (Gini, its own candidate splits and order of ties), grown on what is not zero.

    The library's tree keeps every feature of every row and adds up every bin of
    every feature for every node.  Here a level counts the entries of the rows by
    node, feature, value and label, before the shuffle; what a node's rows do not
    hold is its zeros.  The driver gets one split per node.  Up to 10,000 rows
    both give the same tree; beyond, the library draws a sample for its candidate
    splits, and here all rows count.
    """

    maxDepth = Param(Params._dummy(), "maxDepth", "most splits on a path", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "most classes of a feature's values", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", maxDepth: int = 5, maxBins: int = 32
    ):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(maxDepth=5, maxBins=32)

    def _fit(self, dataset: DataFrame) -> SparseTreeModel:
        indices, values = _entries(F.col(self.getFeaturesCol()))
        label = F.col(self.getLabelCol()).cast("int").alias("label")
        rows = materialize(dataset.select(label, indices.alias("indices"), values.alias("values")), "tree_rows")
        found = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
        if not found:
            raise ValueError("a tree needs at least one row")
        n_classes = _class_count(dataset, self.getLabelCol()) or max(found) + 1
        counts = {1: [found.get(k, 0) for k in range(n_classes)]}
        splits = _grow(rows, counts, self.getOrDefault("maxDepth"), self.getOrDefault("maxBins"))
        nodes = [[node, *splits.get(node, (None, None)), counts[node]] for node in sorted(counts)]
        return self._copyValues(SparseTreeModel(nodes=json.dumps(nodes)))


class SparseTreeModel(Model, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Prediction, class counts and class shares of the leaf of a row, by plain column tests."""

    nodes = Param(
        Params._dummy(), "nodes", "JSON rows of number, feature, threshold, label counts", TypeConverters.toString
    )

    @keyword_only
    def __init__(self, *, nodes: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = json.loads(self.getOrDefault("nodes"))
        counts = {node: found for node, _, _, found in rows}
        splits = _pruned({node: (f, t) for node, f, t, _ in rows if f is not None}, counts)

        def leaf(node: int) -> Column:
            found = [float(c) for c in counts[node]]
            return F.struct(
                F.lit(float(_likeliest(found))).alias("prediction"),
                F.array(*map(F.lit, found)).alias("raw"),
                F.array(*(F.lit(c / sum(found)) for c in found)).alias("share"),
            )

        reached = _walk(splits, *_entries(F.col(self.getFeaturesCol())), leaf)
        return dataset.withColumns(
            {
                self.getRawPredictionCol(): array_to_vector(reached["raw"]),
                self.getProbabilityCol(): array_to_vector(reached["share"]),
                self.getPredictionCol(): reached["prediction"],
            }
        )


def _class_count(df: DataFrame, label: str) -> int:
    """How many values the indexer gave the label, seen or not; 0 where the column does not say."""
    return len(df.schema[label].metadata.get("ml_attr", {}).get("vals", []))


def _entries(vector: Column) -> tuple[Column, Column]:
    """Positions and values of a vector; a dense one has all positions."""
    raw = F.unwrap_udt(vector)
    return F.coalesce(raw["indices"], F.transform(raw["values"], lambda _, place: place)), raw["values"]


def _walk(
    splits: Mapping[int, Split], indices: Column, values: Column, end: Callable[[int], Column], node: int = 1
) -> Column:
    """What ``end`` gives for the node without a split that a row comes to; children of n are 2n and 2n + 1."""
    if node not in splits:
        return end(node)
    feature, threshold = splits[node]
    value = F.coalesce(F.get(values, (F.array_position(indices, feature) - 1).cast("int")), F.lit(0.0))
    left, right = (_walk(splits, indices, values, end, child) for child in (2 * node, 2 * node + 1))
    return F.when(value <= threshold, left).otherwise(right)


def _grow(rows: DataFrame, counts: dict[int, list[int]], depth: int, max_bins: int) -> dict[int, Split]:
    """The splits of all nodes, level by level; the children's label counts are added to ``counts``."""
    n_rows = sum(counts[1])
    open_nodes, splits, thresholds = [1], {}, None
    for _ in range(depth):
        open_nodes = [node for node in open_nodes if _impurity(counts[node]) >= _NONE]
        if not open_nodes:
            break
        stats = materialize(_value_counts(rows, splits, open_nodes, len(counts[1])), "tree_counts")
        if thresholds is None:
            thresholds = materialize(_thresholds(stats, n_rows, min(max_bins, n_rows) - 1), "tree_thresholds")
        best = _best_splits(stats, thresholds, {node: counts[node] for node in open_nodes})
        open_nodes = []
        for node, (split, left) in sorted(best.items()):
            splits[node] = split
            counts[2 * node] = left
            counts[2 * node + 1] = [both - part for both, part in zip(counts[node], left)]
            open_nodes += [2 * node, 2 * node + 1]
    return splits


def _value_counts(rows: DataFrame, splits: Mapping[int, Split], open_nodes: Sequence[int], n_classes: int) -> DataFrame:
    """Rows per open node, feature, value that is not zero, and label (columns c0, c1, ...)."""
    wanted = set(open_nodes)
    node = _walk(splits, F.col("indices"), F.col("values"), lambda n: F.lit(n if n in wanted else None).cast("int"))
    placed = rows.select("label", node.alias("node"), "indices", "values").where(F.col("node").isNotNull())
    entries = placed.select("node", "label", F.inline_outer(F.arrays_zip("indices", "values"))).where("values <> 0")
    return entries.groupBy("node", F.col("indices").alias("feature"), F.col("values").alias("value")).agg(
        *(F.count_if(F.col("label") == k).alias(f"c{k}") for k in range(n_classes))
    )


def _classes(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c[0] == "c" and c[1:].isdigit()]


def _total(columns: Sequence[Column]) -> Column:
    return sum(columns[1:], columns[0])


def _thresholds(stats: DataFrame, n_rows: int, most: int) -> DataFrame:
    """(feature, thresholds): the library's candidate splits.

    Half way between neighbouring values if these are few; else where a running
    count of rows comes nearest to the next multiple of rows / (most + 1).
    """
    n = _total([F.col(c) for c in _classes(stats)])
    pair = F.struct(F.col("value"), n.cast("double").alias("n"))
    seen = stats.groupBy("feature").agg(F.collect_list(pair).alias("seen"), F.sum(n).alias("filled"))
    zero = F.array(F.struct(F.lit(0.0).alias("value"), (n_rows - F.col("filled")).cast("double").alias("n")))
    every = F.when(F.col("filled") < n_rows, F.concat("seen", zero)).otherwise(F.col("seen"))
    counted = seen.select("feature", F.sort_array(every).alias("seen")).where(F.size("seen") > 1)
    first, rest = F.col("seen")[0], F.slice("seen", F.lit(2), F.size("seen") - 1)
    stride = n_rows / (most + 1)
    start = F.struct(
        first["value"].alias("last"),
        first["n"].alias("passed"),
        F.lit(stride).alias("target"),
        F.array().cast("array<double>").alias("cuts"),
    )

    def step(state: Column, item: Column) -> Column:
        passed = state["passed"] + item["n"]
        cut = (F.size("seen") - 1 <= most) | (
            F.abs(state["passed"] - state["target"]) < F.abs(passed - state["target"])
        )
        middle = F.array((state["last"] + item["value"]) / 2)
        return F.struct(
            item["value"].alias("last"),
            passed.alias("passed"),
            F.when(cut, state["target"] + stride).otherwise(state["target"]).alias("target"),
            F.when(cut, F.concat(state["cuts"], middle)).otherwise(state["cuts"]).alias("cuts"),
        )

    cuts = F.aggregate(rest, start, step, lambda state: state["cuts"])
    return counted.select("feature", cuts.alias("thresholds")).where(F.size("thresholds") > 0)


def _best_splits(
    stats: DataFrame, thresholds: DataFrame, counts: Mapping[int, Sequence[int]]
) -> dict[int, tuple[Split, list[int]]]:
    """Per node the split of highest gain and the label counts of its left side; ties to the first feature, threshold."""
    names = _classes(stats)
    wholes = [(node, _impurity(found), *found) for node, found in counts.items()]
    schema = ", ".join(["node int", "impurity double", *(f"all_{c} long" for c in names)])
    totals = F.broadcast(stats.sparkSession.createDataFrame(wholes, schema))
    held = stats.groupBy("node", "feature").agg(*(F.sum(c).alias(c) for c in names)).join(totals, "node")
    zeros = held.select(
        "node", "feature", F.lit(0.0).alias("value"), *((F.col(f"all_{c}") - F.col(c)).alias(c) for c in names)
    ).where(_total([F.col(c) for c in names]) > 0)

    below = F.size(F.filter("thresholds", lambda t: t < F.col("value")))
    binned = stats.unionByName(zeros).join(thresholds, "feature").withColumn("bin", below)
    in_order = Window.partitionBy("node", "feature").orderBy("value")
    sides = (
        binned.withColumns(
            {"after": F.lead("bin").over(in_order)}
            | {f"left_{c}": F.sum(c).over(in_order.rowsBetween(Window.unboundedPreceding, 0)) for c in names}
        )
        .where("after > bin")
        .join(totals, "node")
    )
    left = [F.col(f"left_{c}").cast("double") for c in names]
    right = [(F.col(f"all_{c}") - F.col(f"left_{c}")).cast("double") for c in names]
    whole = _total([F.col(f"all_{c}") for c in names]).cast("double")
    gain = F.col("impurity")
    for side in (left, right):
        gain = gain - _total(side) / whole * _gini(side)
    choice = F.struct(
        gain.alias("gain"),
        (-F.col("feature")).alias("feature"),
        (-F.col("bin")).alias("bin"),
        F.col("thresholds")[F.col("bin")].alias("threshold"),
        *(f"left_{c}" for c in names),
    )
    choices = sides.select("node", choice.alias("choice")).where("choice.gain > 0")
    best = choices.groupBy("node").agg(F.max("choice").alias("choice"))
    return {
        r["node"]: ((-r["choice"]["feature"], r["choice"]["threshold"]), [r["choice"][f"left_{c}"] for c in names])
        for r in best.collect()
    }


def _gini(counts: Sequence[Any]) -> Any:
    """Gini impurity of label counts, numbers or columns, added up in the library's order."""
    total, left = sum(counts[1:], counts[0]), 1.0
    for c in counts:
        left = left - c / total * (c / total)
    return left


def _impurity(counts: Sequence[int]) -> float:
    return _gini([float(c) for c in counts])


def _likeliest(counts: Sequence[float]) -> int:
    """The label with most rows, the first of several."""
    return max(range(len(counts)), key=lambda k: counts[k])


def _pruned(splits: Mapping[int, Split], counts: Mapping[int, Sequence[int]]) -> dict[int, Split]:
    """``splits`` without those of two leaves that predict the same."""
    kept = dict(splits)
    for node in sorted(splits, reverse=True):
        children = (2 * node, 2 * node + 1)
        if not any(c in kept for c in children) and len({_likeliest(counts[c]) for c in children}) == 1:
            del kept[node]
    return kept
