"""Calendar fields and their cyclic encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(date: str = "date") -> dict[str, Column]:
    weekday = F.weekday(date)  # Monday = 0
    return {
        "hour": F.hour(date),
        "day_of_week": weekday,
        "month": F.month(date),
        "is_weekend": weekday.isin(5, 6).cast("int"),
    }


def cycle_columns(date: str = "date") -> dict[str, Column]:
    angles = {
        "hour": F.hour(date) * (2 * math.pi) / 24,
        "day": F.weekday(date) * (2 * math.pi) / 7,
        "month": F.month(date) * (2 * math.pi) / 12,
    }
    out = {}
    for name, angle in angles.items():
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


def forecast_label(date: Column, days_ahead: Column) -> Column:
    return F.date_format(F.date_add(date, days_ahead), "EEE MMM dd")
