"""Scoring rows, forecast tables and their labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.functions.calendar import forecast_label
from hazeline.functions.measures import aqi_band, peak_tier
from hazeline.schema import INTERVAL_Z, SEQUENCE_LENGTH


def latest_rows(df: DataFrame, rows: int = 1) -> DataFrame:
    """The newest rows per city. Spark limits each group before the shuffle, so a long city stays cheap."""
    newest = Window.partitionBy("city").orderBy(F.col("date").desc())
    return df.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= rows).drop("_rn")


def scorable_cities(df: DataFrame, length: int = SEQUENCE_LENGTH) -> DataFrame:
    """(city, n, scorable): a sequence model needs `length` rows."""
    counts = df.groupBy("city").agg(F.count("*").alias("n"))
    return counts.withColumn("scorable", F.col("n") >= length)


def forecast_rows(predictions: DataFrame, models: DataFrame, z: float = INTERVAL_Z) -> DataFrame:
    """Forecast table from predictions (city, day, current_aqi, predicted_aqi) and one model per day.

    `models` has (day, model_used, model_version, rmse): a handful of rows. Days
    without a model are left out; without an rmse the interval is missing.
    """
    margin = F.when(F.col("rmse") != 0, z * F.col("rmse"))
    return predictions.join(F.broadcast(models), "day").select(
        "city", "day", "current_aqi", "predicted_aqi",
        (F.col("predicted_aqi") - margin).alias("ci_low"),
        (F.col("predicted_aqi") + margin).alias("ci_high"),
        "model_used", "model_version",
    )


def persistence_forecast(df: DataFrame, days: Sequence[int]) -> DataFrame:
    """(city, date, day, current_aqi, predicted_aqi) from the latest row per city."""
    day = F.explode(F.array(*map(F.lit, days))).alias("day")
    return latest_rows(df.select("city", "date", "european_aqi")).select(
        "city", "date", day, F.col("european_aqi").alias("current_aqi"), F.col("european_aqi").alias("predicted_aqi")
    )


def forecast_peak(forecast: DataFrame) -> DataFrame:
    """(city, peak, label, tier) over the forecast days."""
    peaks = forecast.groupBy("city").agg(F.max("predicted_aqi").alias("peak"))
    return peaks.select("city", "peak", aqi_band(F.col("peak")).alias("label"), peak_tier(F.col("peak")).alias("tier"))


def forecast_labels(df: DataFrame, days: Sequence[int]) -> DataFrame:
    """(city, day, label): weekday, month and day of each forecast day."""
    day = F.explode(F.array(*map(F.lit, days))).alias("day")
    newest = df.groupBy("city").agg(F.max("date").alias("date"))
    return newest.select("city", "date", day).select("city", "day", forecast_label(F.to_date("date"), F.col("day")).alias("label"))


def history(df: DataFrame) -> DataFrame:
    return df.select("city", "date", "european_aqi").na.drop()
