"""Forecasts and alerts for all cities at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.learn.models import MODELS, DeltaForecaster
from hazeline.learn.validation import union_all
from hazeline.operators.alerts import aqi_alerts
from hazeline.operators.forecast import forecast_rows, latest_rows
from hazeline.schema import ALERT_THRESHOLD
from hazeline.sources.registry import ModelRegistry, best_version, production_model


def chosen_models(registry: ModelRegistry, kinds: Sequence[str] = tuple(MODELS)) -> DataFrame:
    """(horizon, model, version, rmse, path): the best version of the best candidate per horizon."""
    best = best_version(registry.rows())
    model = F.regexp_extract("name", r"^aqi_(.*)_h\d+$", 1)
    return production_model(
        best.select("horizon", model.alias("model"), "version", "rmse", "path"), kinds
    )


def forecast(features: DataFrame, registry: ModelRegistry, days: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Forecast table from the newest complete row per city; days without a model are left out."""
    newest = latest_rows(features)
    models = [m for m in chosen_models(registry).collect() if m["horizon"] in days]  # one row per horizon
    if not models:
        raise RuntimeError("no model is registered for these days")
    predictions = union_all([
        DeltaForecaster.load(m["path"]).predict(newest).select(
            "city", F.lit(m["horizon"]).alias("day"), F.col("european_aqi").alias("current_aqi"),
            F.col("predicted").alias("predicted_aqi"),
        )
        for m in models
    ])
    chosen = chosen_models(registry).select(
        F.col("horizon").alias("day"), F.col("model").alias("model_used"),
        F.col("version").alias("model_version"), "rmse",
    )
    return forecast_rows(predictions, chosen)


def alerts(forecasts: DataFrame, days: int = 3, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Alert rows for a forecast table; a city has one row per day, so its array is short."""
    by_day = F.map_from_entries(F.collect_list(F.struct("day", "predicted_aqi")))
    readings = forecasts.groupBy("city").agg(F.max("current_aqi").alias("current_aqi"), by_day.alias("_by_day"))
    ahead = F.transform(F.sequence(F.lit(1), F.lit(days)), lambda d: F.try_element_at("_by_day", d))
    return aqi_alerts(readings.select("city", "current_aqi", ahead.alias("predictions")), threshold)
