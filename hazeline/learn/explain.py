"""What a fitted model relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.learn.models import LABEL, SCALED, DeltaForecaster
from hazeline.sources.cities import literal_rows

TOP_FEATURES = 15


def importances(model: DeltaForecaster, df: DataFrame) -> DataFrame:
    """(feature, importance): tree importances, or coefficient sizes."""
    regressor = model.regressor
    values = regressor.featureImportances if hasattr(regressor, "featureImportances") else regressor.coefficients
    rows = [(c, float(abs(v))) for c, v in zip(model.features, values.toArray())]  # one row per feature
    return literal_rows(df.sparkSession, rows, "feature, importance")


def top_features(model: DeltaForecaster, df: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    return importances(model, df).orderBy(F.desc("importance"), "feature").limit(n)


def linear_attribution(model: DeltaForecaster, test: DataFrame) -> DataFrame:
    """(feature, mean_abs): mean size of coef * (x - mean(x)) over all test rows."""
    sample = test
    for stage in model.pipeline.stages[:-2]:
        sample = stage.transform(sample)
    names = [SCALED + c for c in model.features]
    means = sample.agg(*[F.avg(c).alias(c) for c in names]).first()
    coefficients = dict(zip(names, map(float, model.regressor.coefficients.toArray())))
    sizes = sample.agg(*[F.avg(F.abs((F.col(c) - means[c]) * coefficients[c])).alias(c) for c in names])
    entries = F.array(*[
        F.struct(F.lit(c.removeprefix(SCALED)).alias("feature"), F.col(f"`{c}`").alias("mean_abs")) for c in names
    ])
    return sizes.select(F.inline(entries)).orderBy(F.desc("mean_abs"), "feature")


def boosting_curve(model: DeltaForecaster, train: DataFrame) -> DataFrame:
    """(round, train_rmse, validation_rmse, kept) for each round grown: the model keeps the rounds up to the best before
    patience ran out; later rounds were grown and dropped, and have no error on `train`. Without held-out rows nothing
    was compared, and there is no round to show."""
    if not model.errors:
        return train.sparkSession.createDataFrame([], "round int, train_rmse double, validation_rmse double, kept boolean")
    assembled = model.pipeline.stages[-2].transform(train).select("features", LABEL)
    kept = [float(e) ** 0.5 for e in model.regressor.evaluateEachIteration(assembled, "squared")]
    errors = [float(e) ** 0.5 for e in model.errors]
    rows = [(i + 1, kept[i] if i < len(kept) else None, e, i < len(kept)) for i, e in enumerate(errors)]
    return literal_rows(train.sparkSession, rows, "round, train_rmse, validation_rmse, kept")
