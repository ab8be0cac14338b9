"""Row-wise expressions over weather and pollutant readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeline.schema import AQI_BANDS, OZONE_FLOOR, PM10_OFFSET


def clip_lower(value: Column, floor) -> Column:
    """Missing stays missing; plain `greatest` would turn it into the floor."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def clip_upper(value: Column, ceiling) -> Column:
    limit = ceiling if isinstance(ceiling, Column) else F.lit(ceiling)
    return F.when(value.isNotNull(), F.least(value, limit))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def wind_columns(speed: str = "wind_speed_10m", direction: str = "wind_direction_10m") -> dict[str, Column]:
    angle = F.radians(direction)
    return {"wind_u": -F.col(speed) * F.sin(angle), "wind_v": -F.col(speed) * F.cos(angle)}


def ratio_columns() -> dict[str, Column]:
    return {
        "pm_ratio": F.try_divide(F.col("pm2_5"), F.col("pm10") + PM10_OFFSET),
        "no2_o3_ratio": F.col("nitrogen_dioxide") / clip_lower(F.col("ozone"), OZONE_FLOOR),
    }


def aqi_band(value: Column) -> Column:
    """Label by the first ceiling that holds the value; null for a missing value."""
    label = F.lit("Hazardous")
    for ceiling, name in reversed(AQI_BANDS):
        label = F.when(value <= ceiling, name).otherwise(label)
    return F.when(value.isNotNull(), label)


def health_tier(value: Column) -> Column:
    return F.when(value <= 50, "good").when(value <= 100, "moderate").when(value.isNotNull(), "bad")


def peak_tier(value: Column) -> Column:
    return F.when(value > 150, "bad").when(value > 100, "moderate").when(value.isNotNull(), "none")
