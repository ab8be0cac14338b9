"""Boosted trees with patience: grown in stages, scored round by round on rows held out, cut back to the best round."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATIENCE = 50


def chosen_round(errors: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """The best round (from 1) before `patience` rounds went by without a better one, and whether they did go by."""
    best = 0
    for at, error in enumerate(errors):
        if error < errors[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def first_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The ensemble of the first trees only."""
    java, context = model._java_obj, SparkContext.getOrCreate()
    kind = context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = context._gateway.new_array(kind, rounds), context._gateway.new_array(context._jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(java.trees()[:rounds], java.treeWeights()[:rounds])):
        trees[i], weights[i] = tree, weight
    cut = context._jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), trees, weights, java.numFeatures())
    return GBTRegressionModel(java.copyValues(cut, java.extractParamMap()))


def first_trees(model: RandomForestRegressionModel, n: int) -> RandomForestRegressionModel:
    """The forest of the first trees only."""
    java, context = model._java_obj, SparkContext.getOrCreate()
    trees = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    for i, tree in enumerate(java.trees()[:n]):
        trees[i] = tree
    cut = context._jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(java.uid(), trees, java.numFeatures())
    cut = java.copyValues(cut, java.extractParamMap())
    return RandomForestRegressionModel(cut.set(cut.getParam("numTrees"), n))


def grow(train: DataFrame, label: str, held_out: str, patience: int = PATIENCE, **settings) -> tuple[GBTRegressionModel, list[float]]:
    """The model up to its best round, and the squared error of the held-out rows after each round grown.

    `train` has `features`, `label` and a flag of the rows held out. Rounds double from stage to stage until `patience`
    rounds have brought nothing or `maxIter` is reached; a stage grows the same first trees as the one before, so it costs
    no more than all rounds once again. A stage is a Spark job of its own: only its errors come to the driver. Without
    rows held out there is nothing to stop for, and all rounds are grown and kept.
    """
    most = settings.pop("maxIter")
    rows = train.select("features", label, held_out).persist()
    try:
        kept, tail = rows.where(~F.col(held_out)), rows.where(held_out)
        if tail.isEmpty():
            return GBTRegressor(labelCol=label, maxIter=most, **settings).fit(kept), []
        rounds = min(most, 2 * patience)
        while True:
            model = GBTRegressor(labelCol=label, maxIter=rounds, **settings).fit(kept)
            errors = model.evaluateEachIteration(tail, "squared")
            best, done = chosen_round(errors, patience)
            if done or rounds == most:
                return first_rounds(model, best), errors
            rounds = min(most, 2 * rounds)
    finally:
        rows.unpersist()
