"""Alerts as rows; delivering them is left to whoever reads the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.measures import aqi_band
from hazeline.schema import ALERT_THRESHOLD, DECAY_LIMIT_PERCENT


def fixed(value: Column, places: int) -> Column:
    return F.format_string(f"%.{places}f", value)


def aqi_alerts(readings: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """(city, kind, day, value, label, message) for values above the threshold.

    `readings` has (city, current_aqi, predictions) with one array entry per day
    ahead; missing predictions raise nothing.
    """
    current = F.struct(F.lit("current").alias("kind"), F.lit(0).alias("day"), F.col("current_aqi").alias("value"))
    ahead = F.transform(
        "predictions",
        lambda p, i: F.struct(F.lit("forecast").alias("kind"), (i + 1).cast("int").alias("day"), p.alias("value")),
    )
    rows = readings.select("city", F.inline(F.concat(F.array(current), ahead))).where(F.col("value") > threshold)
    label = aqi_band(F.col("value"))
    shown = fixed(F.col("value"), 0)
    limit = F.lit(f"{threshold:g}")
    message = F.when(
        F.col("kind") == "current",
        F.concat("city", F.lit(": index "), shown, F.lit(" now, "), label, F.lit("; limit "), limit),
    ).otherwise(
        F.concat("city", F.lit(": index "), shown, F.lit(" expected on day +"), F.col("day").cast("string"), F.lit(", "),
                 label, F.lit("; limit "), limit),
    )
    return rows.select("city", "kind", "day", "value", label.alias("label"), message.alias("message"))


def drift_alert(summary: DataFrame, city: str) -> DataFrame:
    """(city, kind, value, message) from a drift summary whose verdict is drift."""
    names = F.array_join("drifted_features", ", ")
    listed = F.when(F.size("drifted_features") > 0, names).otherwise("-")
    message = F.concat(F.lit(f"{city}: inputs drifted, share "), fixed(F.col("share_drifted"), 3), F.lit("; columns "), listed)
    return summary.where("dataset_drift").select(
        F.lit(city).alias("city"), F.lit("drift").alias("kind"), F.col("share_drifted").alias("value"),
        message.alias("message"),
    )


def decay_alerts(live: DataFrame, baseline: DataFrame, by: str = "horizon",
                 limit: float = DECAY_LIMIT_PERCENT) -> DataFrame:
    """(horizon, rmse, baseline_rmse, degradation, message) where the live error is too far above the baseline's."""
    joined = live.select(by, "rmse").join(baseline.select(by, F.col("rmse").alias("baseline_rmse")), by)
    degradation = F.try_divide(F.col("rmse") - F.col("baseline_rmse"), F.col("baseline_rmse")) * 100
    message = F.concat(
        F.lit("horizon "), F.col(by).cast("string"), F.lit(": error "), fixed(F.col("baseline_rmse"), 2), F.lit(" -> "),
        fixed(F.col("rmse"), 2), F.lit(", up by percent "), fixed(F.col("degradation"), 1),
    )
    return joined.withColumn("degradation", degradation).where(F.col("degradation") > limit).withColumn("message", message)
