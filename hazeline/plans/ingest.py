"""Backfill and incremental refresh of the feature table."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame

from hazeline.operators.features import add_features, complete_rows
from hazeline.operators.quality import check_features, check_raw
from hazeline.schema import FORECAST_HORIZON, LOOKBACK_DAYS
from hazeline.session import written
from hazeline.sources.feature_table import FeatureTable
from hazeline.sources.files import between_days, clean, merge_readings


def engineered_rows(
    weather: DataFrame, air: DataFrame, start: str, end: str, horizon: int = FORECAST_HORIZON, check: bool = True
) -> DataFrame:
    """Merge, check, add features, keep complete rows for an inclusive range of days."""
    merged = clean(merge_readings(between_days(weather, start, end), between_days(air, start, end)))
    if check:
        merged = check_raw(written(merged, "merged"))  # read by the checks and by the features
    return complete_rows(check_features(add_features(merged, horizon)))


def backfill(
    weather: DataFrame, air: DataFrame, table: FeatureTable, start: str, end: str, horizon: int = FORECAST_HORIZON
) -> FeatureTable:
    table.upsert(engineered_rows(weather, air, start, end, horizon))
    return table


def refresh_range(today: date, lookback_days: int = LOOKBACK_DAYS) -> tuple[str, str]:
    """From `lookback_days` before yesterday to yesterday. The first two weeks only warm the windows up."""
    end = today - timedelta(days=1)
    return str(end - timedelta(days=lookback_days)), str(end)


def refresh(
    weather: DataFrame, air: DataFrame, table: FeatureTable, today: date, lookback_days: int = LOOKBACK_DAYS,
    horizon: int = FORECAST_HORIZON, warmup_days: int = 0,
) -> FeatureTable:
    """Recompute the trailing days and upsert the complete ones.

    Without warm-up, only rows two weeks into the range are complete, so targets
    that have become known since are filled for those alone. `warmup_days` reads
    that much further back and refreshes the whole range.
    """
    start, end = refresh_range(today, lookback_days)
    first = str(date.fromisoformat(start) - timedelta(days=warmup_days))
    table.upsert(between_days(engineered_rows(weather, air, first, end, horizon), start, end))
    return table
