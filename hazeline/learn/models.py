"""Regressors for the delta target, as Spark ML pipelines."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegressionModel, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.learn.boosting import grow
from hazeline.learn.ridge_path import block_moments, solve
from hazeline.operators.profile import model_columns, robust_scaling
from hazeline.operators.splits import tail_flag

LABEL = "target_delta"
SCALED = "_scaled_"
VALIDATION = "_validation"

# Model settings of the training job.
MODELS = {
    "linear": {"alpha": 0.1},
    "random_forest": {"numTrees": 200, "maxDepth": 15, "minInstancesPerNode": 2, "seed": 42},
    "boosted": {"maxIter": 1000, "stepSize": 0.03, "maxDepth": 4, "subsamplingRate": 0.7,
                "featureSubsetStrategy": "0.7", "patience": 50, "seed": 42},
}


class _ScalingParams(Params):
    columns = Param(Params._dummy(), "columns", "columns to scale", TypeConverters.toListString)
    centres = Param(Params._dummy(), "centres", "fitted medians", TypeConverters.toListFloat)
    widths = Param(Params._dummy(), "widths", "fitted interquartile ranges", TypeConverters.toListFloat)


class RobustScaling(Estimator, _ScalingParams, DefaultParamsReadable, DefaultParamsWritable):
    """(x - median) / iqr into new columns, with exact interpolated quartiles."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str] = ()):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RobustScalingModel:
        names = self.getOrDefault("columns")
        fitted = {r["column"]: r for r in robust_scaling(dataset, names).collect()}  # one row per column
        return RobustScalingModel(
            columns=names, centres=[fitted[c]["median"] for c in names], widths=[fitted[c]["iqr"] for c in names]
        )


class RobustScalingModel(Model, _ScalingParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, columns: Sequence[str] = (), centres: Sequence[float] = (), widths: Sequence[float] = ()):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        parts = zip(*(self.getOrDefault(p) for p in ("columns", "centres", "widths")))
        return dataset.withColumns({SCALED + c: (F.col(c) - mid) / width for c, mid, width in parts})


def ridge(train: DataFrame, features: Sequence[str], scaling: RobustScalingModel, alpha: float) -> LinearRegressionModel:
    """Ridge on scaled columns with an unpenalised intercept, solved from one pass of moments.

    The ready-made solver gives up the closed form when a column is constant, as the month is in a short series.
    """
    moments = block_moments(train.withColumn("block", F.lit(0)), [*features, LABEL])[0]
    centres, widths = (np.array(scaling.getOrDefault(p)) for p in ("centres", "widths"))
    beta, intercept = solve(moments, widths, alpha)
    jvm = train.sparkSession._jvm
    vector = _py2java(train.sparkSession.sparkContext, Vectors.dense(beta * widths))
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("ridge")
    return LinearRegressionModel(jvm.org.apache.spark.ml.regression.LinearRegressionModel(uid, vector, float(intercept + beta @ centres)))


@dataclass
class DeltaForecaster:
    """A fitted pipeline with what it was trained on."""

    kind: str
    horizon: int
    features: list[str]
    pipeline: PipelineModel
    errors: tuple[float, ...] = ()  # of a boosted model: squared error of the held-out tail after each round grown

    @property
    def regressor(self):
        return self.pipeline.stages[-1]

    def predict(self, df: DataFrame) -> DataFrame:
        """Add `predicted` = current index + predicted change."""
        scored = self.pipeline.transform(df)
        return scored.select(*df.columns, (F.col("european_aqi") + F.col("prediction")).alias("predicted"))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        facts = json.dumps({"kind": self.kind, "horizon": self.horizon, "features": self.features, "errors": self.errors})
        _session().createDataFrame([(facts,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")

    @classmethod
    def load(cls, path: str) -> DeltaForecaster:
        facts = json.loads(_session().read.text(f"{path}/facts").first()[0])
        facts["errors"] = tuple(facts.get("errors", ()))
        return cls(pipeline=PipelineModel.load(f"{path}/pipeline"), **facts)


def _session() -> SparkSession:
    return SparkSession.getActiveSession()


def mark_tail(train: DataFrame, share: float = 0.1) -> DataFrame:
    """Flag the last part of the training rows for early stopping; test rows stay unseen."""
    return train.withColumn(VALIDATION, tail_flag(train, share))


def fit(
    kind: str, train: DataFrame, horizon: int, settings: dict | None = None, features: Sequence[str] | None = None
) -> DeltaForecaster:
    """Fit one model kind on rows from `delta_target`."""
    if kind not in MODELS:
        raise ValueError(f"no model of kind {kind}; there are {sorted(MODELS)}")
    features = list(features or model_columns(train.drop("target")))
    settings = {**MODELS[kind], **(settings or {})}
    if kind == "linear":
        scaling = RobustScaling(columns=features).fit(train)
        assembler = VectorAssembler(inputCols=[SCALED + c for c in features], outputCol="features")
        model = ridge(train, features, scaling, settings["alpha"])
        return DeltaForecaster(kind, horizon, features, PipelineModel([scaling, assembler, model]))
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    if kind == "boosted":
        rows = assembler.transform(mark_tail(train).select(*dict.fromkeys([*features, LABEL, VALIDATION])))
        model, errors = grow(rows, LABEL, VALIDATION, **settings)
        return DeltaForecaster(kind, horizon, features, PipelineModel([assembler, model]), tuple(errors))
    forest = RandomForestRegressor(labelCol=LABEL, **{"featureSubsetStrategy": "all", **settings})
    pipeline = Pipeline(stages=[assembler, forest]).fit(train.select(*dict.fromkeys([*features, LABEL])))
    return DeltaForecaster(kind, horizon, features, pipeline)


Builder = Callable[[DataFrame], DeltaForecaster]


def builder(kind: str, horizon: int, settings: dict | None = None) -> Builder:
    """A function that fits a fresh model of this kind."""
    return lambda train: fit(kind, train, horizon, settings)
