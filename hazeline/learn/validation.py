"""Walk-forward validation and parameter search on expanding folds."""

from __future__ import annotations

import hashlib
import itertools
import json
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.learn.boosting import first_rounds, first_trees
from hazeline.learn.models import Builder, DeltaForecaster, fit
from hazeline.operators.metrics import score
from hazeline.operators.splits import blocks, fold
from hazeline.session import scratch_path, written
from hazeline.sources.cities import literal_rows

PARALLEL_FITS = 4  # Spark jobs submitted at once; each is itself distributed

# Search spaces.
FOREST_GRID = {
    "numTrees": [100, 150], "maxDepth": [12, 15], "minInstancesPerNode": [7, 10],
    "featureSubsetStrategy": ["sqrt", "0.5", "log2"],
}
FOREST_SPACE = {
    "numTrees": [100, 200], "maxDepth": [5, 8, 12, 15], "minInstancesPerNode": [8, 12, 20],
    "featureSubsetStrategy": ["sqrt", "log2", "0.5"], "bootstrap": [True, False],
}
BOOSTED_SPACE = {
    "maxDepth": [3, 6, 8], "stepSize": [0.01, 0.03, 0.05], "subsamplingRate": [0.6, 0.7, 0.9],
    "featureSubsetStrategy": ["0.7", "0.8", "1.0"], "maxIter": [200, 100],
}


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def scored_rows(model, test: DataFrame) -> DataFrame:
    return model.predict(test).select(
        "city", "date", F.col("target").alias("actual"), "predicted", F.col("european_aqi").alias("naive")
    )


def walk_forward(rows: DataFrame, build: Builder, n_splits: int = 5) -> DataFrame:
    """(fold, n, model and naive scores): a fresh model per fold, scored at once and let go."""
    blocked = written(blocks(rows, n_splits), "blocked")

    def one(number: int) -> DataFrame:
        train, test = fold(blocked, number)
        return written(score(scored_rows(build(train.drop("block")), test).withColumn("fold", F.lit(number)), ["fold"]), "fold-score")

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        return union_all(list(pool.map(one, range(1, n_splits + 1))))


def combinations(space: dict[str, list]) -> list[dict]:
    return [dict(zip(space, values)) for values in itertools.product(*space.values())]


def sampled(space: dict[str, list], n: int, seed: int = 42) -> list[dict]:
    """`n` distinct settings; all of them if there are fewer."""
    every = combinations(space)
    return every if n >= len(every) else random.Random(seed).sample(every, n)


def _grown(kind: str, settings: Sequence[dict]) -> list[tuple[dict, list[int]]]:
    """Settings to fit, each with the indices it serves: ensembles that differ only in their size are grown once, at the
    largest size, and scored after their first trees too."""
    size = {"random_forest": "numTrees", "boosted": "maxIter"}.get(kind)
    groups: dict[str, list[int]] = {}
    for i, s in enumerate(settings):
        groups.setdefault(json.dumps({k: v for k, v in s.items() if k != size}, sort_keys=True), []).append(i)
    return [(max((settings[i] for i in some), key=lambda s: s.get(size, 0)), some) for some in groups.values()]


def _sized(model: DeltaForecaster, settings: dict) -> DeltaForecaster:
    regressor = model.regressor
    wanted = settings.get({"random_forest": "numTrees", "boosted": "maxIter"}.get(model.kind), None)
    if wanted is None or wanted >= regressor.getNumTrees:
        return model
    cut = first_trees(regressor, wanted) if model.kind == "random_forest" else first_rounds(regressor, wanted)
    return replace(model, pipeline=PipelineModel([*model.pipeline.stages[:-1], cut]))


class TrialScores:
    """Scores of finished fits in a folder, one small file each, so that a search that was cut short goes on from them.

    A file counts once its commit marker is there; a fit that was under way is done again. `name` tells searches over
    different rows apart.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.name = spark, folder.rstrip("/"), name

    def key(self, kind: str, horizon: int, settings: dict, n_splits: int, fold: int) -> str:
        said = json.dumps([self.name, kind, horizon, settings, n_splits, fold], sort_keys=True)
        return hashlib.sha256(said.encode()).hexdigest()[:32]

    def _path(self, key: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{key}")

    def done(self) -> set[str]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return set()
        kept = files.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/*/_SUCCESS"))
        return {x.getPath().getParent().getName() for x in kept}

    def add(self, key: str, row: dict) -> None:
        self.spark.createDataFrame([(json.dumps(row),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/{key}")

    def rows(self, keys: Sequence[str]) -> list[dict]:
        """One row for each fit."""
        return [json.loads(r[0]) for r in self.spark.read.text([f"{self.folder}/{k}" for k in keys]).collect()] if keys else []


def search(
    rows: DataFrame, kind: str, horizon: int, settings: Sequence[dict], n_splits: int = 5, scores: TrialScores | None = None, parallel: int = PARALLEL_FITS,
) -> DataFrame:
    """(settings, folds, mean_mse, mean_rmse), best first.

    Folds expand in time; the ready-made cross validator would train on the future of its test rows. At most `parallel`
    fits run at once; each is scored at once, to one row per setting it serves, and its model let go. With `scores`, the
    rows are kept in its folder, and fits whose rows are there already are not run again.
    """
    blocked = written(blocks(rows, n_splits), "blocked")
    scores = scores or TrialScores(rows.sparkSession, scratch_path(rows.sparkSession, "trials"), "search")
    known = scores.done()

    def one(job: tuple[tuple[dict, list[int]], int]) -> None:
        (largest, serves), number = job
        open_ = [i for i in serves if scores.key(kind, horizon, settings[i], n_splits, number) not in known]
        if not open_:
            return
        train, test = fold(blocked, number)
        model = fit(kind, train.drop("block"), horizon, largest)
        for i in open_:
            row = score(scored_rows(_sized(model, settings[i]), test), [], naive=None).first()
            scores.add(scores.key(kind, horizon, settings[i], n_splits, number), {"fold": number, "settings": settings[i], "mse": row["mse"], "rmse": row["rmse"]})

    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(one, itertools.product(_grown(kind, settings), range(1, n_splits + 1))))
    every = scores.rows([scores.key(kind, horizon, s, n_splits, f) for s in settings for f in range(1, n_splits + 1)])
    per_fold = literal_rows(rows.sparkSession, [(json.dumps(r["settings"], sort_keys=True), r["fold"], r["mse"], r["rmse"]) for r in every], "settings, fold, mse, rmse")
    return per_fold.groupBy("settings").agg(
        F.count("*").alias("folds"), F.avg("mse").alias("mean_mse"), F.avg("rmse").alias("mean_rmse")).orderBy("mean_mse", "settings")
