"""Landed provider payloads: hourly arrays to rows, and current readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.sources.feature_table import utc_clock


def explode_hourly(payloads: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One row per time step.

    A payload row holds city, lat, lon, `tz`, epoch seconds `time` (first step)
    and `time_end` (exclusive), the step `interval` in seconds, and one array per
    variable. `date` is the instant as UTC clock; `local_date`, the clock of the
    payload's zone, repeats or skips an hour where that zone changes its offset.
    """
    # div rounds down, so a last partial step is left out as in a left-closed range
    steps = F.expr("cast((time_end - time + interval - 1) div interval as int)")
    step = payloads.where(F.col("time_end") > F.col("time")).withColumn(
        "_step", F.explode(F.sequence(F.lit(0), steps - 1))
    )
    utc = F.timestamp_seconds(F.col("time") + F.col("_step") * F.col("interval"))
    local = F.convert_timezone(F.lit("UTC"), F.col("tz"), utc_clock(utc))
    return step.select(
        utc_clock(utc).alias("date"), local.alias("local_date"), "city", "lat", "lon",
        *[F.get(F.col(v), F.col("_step")).alias(v) for v in variables],
    )


def latest_reading(df: DataFrame) -> DataFrame:
    """The newest row per city; `max_by` combines map-side, so a long city is no hot spot."""
    rest = [c for c in df.columns if c != "city"]
    newest = df.groupBy("city").agg(F.max_by(F.struct(*rest), "date").alias("_row"))
    return newest.select("city", "_row.*").select(*df.columns)


def merge_current(weather: DataFrame, air: DataFrame) -> DataFrame:
    """One row per city; where both sides have a column, the air value wins."""
    both = [c for c in air.columns if c in weather.columns and c != "city"]
    joined = weather.alias("w").join(air.alias("a"), "city")
    return joined.select(
        "city",
        *[F.coalesce(f"a.{c}", f"w.{c}").alias(c) for c in both],
        *[F.col(f"w.{c}") for c in weather.columns if c not in both and c != "city"],
        *[F.col(f"a.{c}") for c in air.columns if c not in both and c != "city"],
    )


def to_payloads(df: DataFrame, variables: Sequence[str], tz) -> DataFrame:
    """Panel rows to one payload per city and UTC day: the landed form of `explode_hourly`'s input.

    A day holds at most 24 hours, so a group is at most 24 rows. Missing hours
    become nulls inside the arrays.
    """
    day = F.to_date("date")
    by_hour = F.map_from_entries(F.collect_list(F.struct(F.hour("date").alias("h"), F.struct(*variables).alias("v"))))
    grouped = df.groupBy("city", "lat", "lon", day.alias("_day")).agg(by_hour.alias("_hours"))
    start = F.unix_date("_day").cast("bigint") * 86400

    def series(name: str):
        return F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.try_element_at("_hours", h)[name])

    return grouped.select(
        "city", "lat", "lon", tz.alias("tz"), start.alias("time"), (start + 86400).alias("time_end"),
        F.lit(3600).alias("interval"), *[series(v).alias(v) for v in variables],
    )
