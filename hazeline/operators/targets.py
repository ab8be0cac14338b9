"""Training targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.operators.features import drop_incomplete


def delta_target(df: DataFrame, horizon: int, require_all_horizons: bool = False) -> DataFrame:
    """Complete rows for one horizon with `target` and `target_delta` = target - current index.

    Other horizons are left out before rows with a gap are dropped, so that a row
    near the end is kept for the horizons it has. `require_all_horizons` drops
    such rows first, as the exploratory variant does.
    """
    name = f"aqi_next_{horizon}d"
    if name not in df.columns:
        raise ValueError(f"no column {name}; the features were built for fewer days")
    others = [c for c in df.columns if c.startswith("aqi_next_") and c != name]
    rows = df if require_all_horizons else df.drop(*others)
    rows = drop_incomplete(rows, rows.columns)
    return (
        rows.drop(*others)
        .withColumn("target_delta", F.col(name) - F.col("european_aqi"))
        .withColumnRenamed(name, "target")
    )
